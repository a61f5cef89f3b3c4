"""Plain helpers that the brute-force versions share."""


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, now = [], ""
    for c in low + "\n":
        if c.isascii() and not ("0" <= c <= "9" or "a" <= c <= "z"):
            if now:
                out.append(now)
            now = ""
        else:
            now += c
    return out
