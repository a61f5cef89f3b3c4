"""Fixed values of the SQL counterparts, stated apart from the package so that a wrong number there shows.

Natural order, plain text.
"""

# fmt: off
CLASS_KMH = {'motorway': 100,
 'trunk': 70,
 'primary': 65,
 'secondary': 60,
 'tertiary': 50,
 'unclassified': 30,
 'residential': 30,
 'service': 20,
 'motorway_link': 70,
 'trunk_link': 65,
 'primary_link': 60,
 'secondary_link': 50,
 'tertiary_link': 40,
 'living_street': 10,
 'pedestrian': 6,
 'track': 20,
 'road': 35}
CLASS_MPH = {'motorway': 65,
 'trunk': 45,
 'primary': 40,
 'secondary': 35,
 'tertiary': 30,
 'unclassified': 20,
 'residential': 20,
 'service': 15,
 'motorway_link': 45,
 'trunk_link': 40,
 'primary_link': 35,
 'secondary_link': 30,
 'tertiary_link': 25,
 'living_street': 5,
 'pedestrian': 5,
 'track': 15,
 'road': 20}
COUNTRY_KMH = {'at:urban': 50,
 'at:rural': 100,
 'at:trunk': 100,
 'at:motorway': 130,
 'ch:urban': 50,
 'ch:rural': 80,
 'ch:trunk': 100,
 'ch:motorway': 120,
 'cz:urban': 50,
 'cz:rural': 90,
 'cz:trunk': 130,
 'cz:motorway': 130,
 'dk:urban': 50,
 'dk:rural': 80,
 'dk:motorway': 130,
 'de:living_street': 7,
 'de:urban': 50,
 'de:walk': 7,
 'de:rural': 100,
 'fi:urban': 50,
 'fi:rural': 80,
 'fi:trunk': 100,
 'fi:motorway': 120,
 'fr:urban': 50,
 'fr:rural': 90,
 'fr:trunk': 110,
 'fr:motorway': 130,
 'hu:urban': 50,
 'hu:rural': 90,
 'hu:trunk': 110,
 'hu:motorway': 130,
 'it:urban': 50,
 'it:rural': 90,
 'it:trunk': 110,
 'it:motorway': 130,
 'jp:national': 60,
 'jp:motorway': 100,
 'ro:urban': 50,
 'ro:rural': 90,
 'ro:trunk': 100,
 'ro:motorway': 130,
 'ru:living_street': 20,
 'ru:rural': 90,
 'ru:urban': 60,
 'ru:motorway': 110,
 'sk:urban': 50,
 'sk:rural': 90,
 'sk:trunk': 130,
 'sk:motorway': 130,
 'si:urban': 50,
 'si:rural': 90,
 'si:trunk': 110,
 'si:motorway': 130,
 'se:urban': 50,
 'se:rural': 70,
 'se:trunk': 90,
 'se:motorway': 110,
 'gb:nsl_single': 96.54,
 'gb:nsl_dual': 112.63,
 'gb:motorway': 112.63,
 'ua:urban': 60,
 'ua:rural': 90,
 'ua:trunk': 110,
 'ua:motorway': 130,
 'living_street': 6}
NO_INFORMATION = ('maxspeed', 'ambiguous', 'signals', 'none', 'walk', 'variable', 'national', 'fixme', 'unposted', 'implicit')
VELOCITY_KMH = {'km/h': 1.0, 'mph': 1.609344, 'kn': 1.852, 'm/s': 3.6, 'ft/s': 1.09728, 'km/s': 3600.0}
TEXT_UNITS = {'kmh': {'kph': 1.0, 'km/h': 1.0, 'kmh': 1.0, 'mph': 1.609, 'knots': 1.852},
 'mph': {'kph': 0.621371192237334, 'km/h': 1.0, 'kmh': 1.0, 'mph': 1.0, 'knots': 0.868976}}
PATH_CLASSES = ('footway', 'steps', 'bridleway', 'path')
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
VELOCITY = r"^([-+]?[0-9]*[.]?[0-9]+(?:[eE][-+]?[0-9]+)?) *(km/h|mph|kn|m/s|ft/s|km/s)$"
ORDER_WEIGHT = {0: 0.0, 1: 0.7, 2: 0.6, 3: 0.5, 4: 0.3, 5: 0.2, 6: 0.1}
COVER_WEIGHT = {11: 0.0,
 12: 0.15,
 21: 0.9,
 22: 0.9,
 23: 0.9,
 24: 0.95,
 31: 0.1,
 41: 0.7,
 42: 0.65,
 43: 0.75,
 51: 0.75,
 52: 0.75,
 71: 0.8,
 81: 0.8,
 82: 0.8,
 90: 0.2,
 95: 0.25}
MAGMA = ['#000004', '#180f3d', '#440f76', '#721f81', '#9e2f7f', '#cd4071', '#f1605d', '#fd9668', '#feca8d', '#fcfdbf']
METRES_PER_DEGREE = 11320.0
