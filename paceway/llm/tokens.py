"""Token counts of a byte-level BPE vocabulary by a compiled finite-state transducer.

**Compilation.** A token sequence is what the merges give exactly if each neighbouring pair is what the merges give for its two tokens. So the encoding of a prefix ends with the longest token that fits what
stands before it, and the encoding after the next byte depends only on the tokens that end at the last few places, back to the longest suffix that still begins some token. That is a
state; a transition on a byte carries how many tokens the count changes by. States are compiled when they are first met and kept, up to ``cached`` transitions (and the counts of twice as many words). The splitter of text into words
(contractions, letters, digits, other signs, white space with its look-ahead) runs in front of it and resets the state where a word ends.

**Chunks.** A text is cut into chunks of ``chunk`` characters. At a settled place every state leads to the same one, whatever stands before and after it, so the map of a chunk from entry state to exit state and
count is settled but for the stretches before its first and after its last such place: it is ``(head, count, tail)``. Maps compose associatively, tail with head through the transducer. Settled places are single spaces
after a sign that is not white space; a chunk without one falls back on ends of words that no contraction, look-ahead or special string can move: after a letter or digit where neither follows, and between the two.
So Chinese text with its stops, base64, links and lines without spaces have maps as well. A task makes the maps of its chunks; the chunks of a text then meet by row in one task, which composes them one after the
other: some bytes for each chunk, but there is no parallel scan over the chunks of one text.

**What has no map.** A chunk inside a single word (letters only, digits only, signs only, white space only) is not settled anywhere. Its raw text is returned, shuffled and, with what neighbouring chunks leave open,
tokenised in order by the one task that composes its text, so the longest single word is sequential work and is held in memory whole. Counts are right all the same. Nor are the tables bounded inside a word: ``cached``
is tested before a word begins, so a single word of very many letters can add transitions beyond it.

Edge cases: a null or empty text has no bytes and no tokens; special strings in a text are one token each, as the library has it by default; repeated rows are counted one by one; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _machine():
    """The transducer's maker, put together here so that it travels to the workers by value."""

    def make(vocabulary, cached):
        import json
        import re
        import unicodedata

        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        # Bytes stand in the file as printable characters: those that are printable as they are, the rest from 256 up.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        sign = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(plain))}
        byte = {c: b for b, c in sign.items()}
        as_bytes = lambda s: bytes(byte[c] for c in s)
        ranks = {}
        for i, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks[as_bytes(a), as_bytes(b)] = i
        special = [t["content"] for t in spec.get("added_tokens", [])]

        none = len(ranks)

        def stay_apart(a, b):
            """Whether the merges leave two tokens that stand together as they are: no merge over the seam comes first."""
            parts, seam = [*(a[i : i + 1] for i in range(len(a))), *(b[i : i + 1] for i in range(len(b)))], len(a)
            while len(parts) > 1:
                best = none
                for i in range(len(parts) - 1):
                    r = ranks.get((parts[i], parts[i + 1]), none)
                    if r < best:
                        best, at = r, i
                if best == none:
                    break
                if at + 1 == seam:
                    return False
                seam -= at + 1 < seam
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            return parts == [a, b]

        singles = [bytes([b]) for b in range(256)]
        tokens = {a + b for a, b in ranks} | set(singles)
        begins = {t[:i] for t in tokens for i in range(1, len(t))}  # proper beginnings of tokens
        fits, states, names, moves = {}, {}, [], {}

        def compatible(a, b):
            pair = fits.get((a, b))
            if pair is None:
                if len(fits) > cached:
                    fits.clear()
                pair = fits[a, b] = stay_apart(a, b)
            return pair

        def state(key):
            if key not in states:
                states[key] = len(names)
                names.append(key)
            return states[key]

        # A state: the longest suffix that begins a token, and for every place in it where a token may have begun, the token that ends there
        # and the tokens up to there, less those up to the end.
        start = state((b"", ((None, 0),)))

        def compile_move(at, b):
            suffix, ends = names[at]
            text = suffix + bytes([b])
            for at_place, here in enumerate(ends):  # the longest token that fits what stands before it
                if here is None:
                    continue
                token = text[at_place:]
                if token in tokens:
                    before, count = here
                    if before is None or compatible(before, token):
                        break
            change = count + 1
            keep = len(text)
            while keep and text[-keep:] not in begins:
                keep -= 1
            left = text[len(text) - keep :]
            kept = [e and (e[0], e[1] - change) if left[i:] in begins else None for i, e in enumerate(ends[len(ends) - keep :] if keep else ())]
            moves[at << 8 | b] = out = state((left, (*kept, (token, 0)))), change
            return out

        def word_count(word):
            nonlocal start
            if len(moves) > cached:
                states.clear()
                names.clear()
                moves.clear()
                start = state((b"", ((None, 0),)))
            at, n, get = start, 0, moves.get
            for b in word.encode("utf-8", "replace"):
                step = get(at << 8 | b)
                at, change = step or compile_move(at, b)
                n += change
            return n

        spaces = {*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
        kinds = {}

        def kind(c):
            """Letter, number, white space or other."""
            k = kinds.get(c)
            if k is None:
                k = kinds[c] = "s" if ord(c) in spaces else (unicodedata.category(c)[0] if unicodedata.category(c)[0] in "LN" else "o")
            return k

        short = {"'s", "'t", "'m", "'d"}
        long = {"'re", "'ve", "'ll"}

        def split(text):
            """The words of a whole text, spaces with the word they lead."""
            at, n = 0, len(text)
            while at < n:
                begin, k = at, kind(text[at])
                if text[at] == "'" and text[at : at + 2] in short:
                    at += 2
                elif text[at] == "'" and text[at : at + 3] in long:
                    at += 3
                else:
                    if k == "s":
                        while at < n and kind(text[at]) == "s":
                            at += 1
                        if at == n:
                            yield text[begin:]
                            return
                        if at - begin > 1:
                            yield text[begin : at - 1]
                        begin = at - 1
                        if text[begin] != " ":
                            yield text[begin]
                            continue
                        k = kind(text[at])
                    while at < n and kind(text[at]) == k:
                        at += 1
                yield text[begin:at]

        cut_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        words = {}

        def run(text):
            """Tokens of a stretch between two settled places, from the start state."""
            total = 0
            for i, part in enumerate(cut_special.split(text) if cut_special else [text]):
                if i % 2:
                    total += 1
                    continue
                for w in split(part):
                    n = words.get(w)
                    if n is None:
                        n = word_count(w)
                        if len(w) <= 32:
                            words[w] = n
                    total += n
            return total

        settled = re.compile(r"(?<=\S) ")
        known, signs = {}, set("!#$%&()*+,-./:;=?@")

        def count(stretches):
            """Tokens of stretches that each begin with the space that settles them."""
            if len(known) + len(words) > 2 * cached:
                known.clear()
                words.clear()
            total, get = 0, known.get
            for s in stretches:
                n = get(s)
                if n is None:
                    if s.isalpha():  # one word, and no need to look for others
                        n = word_count(" " + s)
                    elif s[-1:] in signs and s[:-1].isalpha():
                        n = get(s[:-1])
                        n = (word_count(" " + s[:-1]) if n is None else n) + 1
                    else:
                        n = run(" " + s)
                    if len(s) <= 32:
                        known[s] = n
                total += n
            return total

        # Ends of words, but for the seams inside special strings.
        seams = {s[i : i + 2] for s in special for i in range(len(s) - 1)}
        unless = "".join(f"(?!(?<={re.escape(s[0])}){re.escape(s[1])})" for s in sorted(seams) if s[0].isalnum())
        ends = re.compile(rf"(?:(?<=[^\W_])(?=[\W_])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])){unless}")

        def chunk_map(text):
            """``(head, count, tail)``; without a settled place, ``(text, None, None)``."""
            parts = settled.split(text)
            if len(parts) > 1:
                return parts[0], count(parts[1:-1]), " " + parts[-1]
            first = last = None
            for place in ends.finditer(text):
                last = place.start()
                first = last if first is None else first
            if first is None:
                return text, None, None
            return text[:first], run(text[first:last]), text[last:]

        def compose(maps):
            """Tokens of a text from the maps of its chunks in order."""
            total, open_text = 0, ""
            for head, n, tail in maps:
                open_text += head
                if n is None:
                    continue
                # The seam may hold settled places of its own.
                parts = settled.split(open_text)
                total += run(parts[0]) + count(parts[1:]) + n
                open_text = tail
            parts = settled.split(open_text)
            return total + run(parts[0]) + count(parts[1:])

        def close():
            """Let go of the tables, which the functions here hold in a circle."""
            for table in (ranks, tokens, begins, fits, states, moves, words, known, kinds):
                table.clear()
            names.clear()

        return chunk_map, compose, close

    return make


def count(docs: DataFrame, vocabulary: str, id_col="doc_id", text_col="text", limit: int = 512, chunk: int = 1 << 16, cached: int = 500_000) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_tokens, over_limit``. ``vocabulary`` is a byte-level BPE file of the tokenizers library."""
    make = _machine()

    def maps(batches):
        import pyarrow as pa

        chunk_map, _, close = make(vocabulary, cached)
        for batch in batches:
            made = [chunk_map(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            head, n, tail = ([m[i] for m in made] for i in range(3))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(head, pa.string()), pa.array(n, pa.int64()), pa.array(tail, pa.string())], names=names)
        close()

    def totals(batches):
        import pyarrow as pa

        _, compose, close = make(vocabulary, cached)
        for batch in batches:
            n = [compose([(m["head"], m["n"], m["tail"]) for m in row]) for row in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])
        close()

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    last = F.greatest((F.char_length("text") - 1).cast("long"), F.lit(0).cast("long")) / chunk
    rows = rows.select("row", "id", F.octet_length("text").cast("long").alias("n_bytes"), F.explode(F.sequence(F.lit(0), F.floor(last).cast("int"))).alias("k"), "text")
    rows = rows.withColumn("text", F.substr("text", F.col("k") * chunk + 1, F.lit(chunk)))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["row", "id", "n_bytes", "k", "head", "n", "tail"]
    made = rows.mapInArrow(maps, f"row long, id {kind}, n_bytes long, k int, head string, n long, tail string")
    whole = made.groupBy("row").agg(F.max(F.struct("id", "n_bytes")).alias("d"), F.array_sort(F.collect_list(F.struct("k", "head", "n", "tail"))).alias("maps"))
    out = whole.select("d.id", "d.n_bytes", "maps").mapInArrow(totals, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
