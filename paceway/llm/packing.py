"""Packing token sequences by estimated cost.

The cost of a piece of ``n`` tokens is ``linear * n + quadratic * n**2``: the second part is attention inside the piece. Documents are cut so that no piece is
longer than a sequence; pieces are taken in descending order of cost, and each goes to the sequence of lowest cost so far that has room for all of it. As many sequences are opened as the tokens
need and no more; a piece that fits nowhere is cut once more to fill the roomiest one, so the padding of a block is less than one sequence.

A task streams over its documents in blocks of ``block_tokens`` tokens and packs each block by itself: there is no shuffle, memory is bounded by a block and a batch,
and a lost task is simply run again. A sequence's number holds the partition's number above and a running number below, so none meets another's.

Edge cases: a null or empty text is just the end id; repeated rows are packed as often as they come; an empty table gives no rows; other columns are not read. Ties in cost are settled by arrival, then by
sequence number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMES = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _placer():
    """The function that places pieces, made here so that it travels to the workers by value."""

    def place(lengths, capacity, linear, quadratic):
        """Pieces ``(document, start, length, sequence, offset)`` of documents with the given numbers of tokens."""
        import heapq

        def cost(n):
            return linear * n + quadratic * n * n

        pieces, rest, used = [], [], 0
        for doc, n in enumerate(lengths):
            whole = n // capacity
            pieces += [(doc, i * capacity, capacity, used + i, 0) for i in range(whole)]
            used += whole
            if n % capacity:
                rest.append((doc, whole * capacity, n % capacity))
        rest.sort(key=lambda p: -cost(p[2]))

        # rooms[r] holds the sequences with room for r more tokens; tree finds the cheapest with at least so much room.
        size = 1 << capacity.bit_length()
        none = (float("inf"), -1)
        rooms, tree = [[] for _ in range(size)], [none] * (2 * size)

        def update(room):
            i = room + size
            tree[i] = rooms[room][0] if rooms[room] else none
            while i > 1:
                i //= 2
                tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def cheapest(room):
            lo, hi, best = room + size, 2 * size, none
            while lo < hi:
                if lo & 1:
                    best = min(best, tree[lo])
                    lo += 1
                if hi & 1:
                    hi -= 1
                    best = min(best, tree[hi])
                lo //= 2
                hi //= 2
            return best

        n_open = -(-sum(p[2] for p in rest) // capacity)
        left = [capacity] * n_open
        rooms[capacity] = [(0.0, s) for s in range(n_open)]
        update(capacity)
        for doc, start, n in rest:
            while n:
                total, s = cheapest(n)
                if s < 0:  # no room for all of it: fill the roomiest
                    i = 1
                    while i < size:
                        i = 2 * i + 1 if tree[2 * i + 1][1] >= 0 else 2 * i
                    total, s = tree[i]
                room = left[s]
                take = min(n, room)
                heapq.heappop(rooms[room])
                update(room)
                left[s] -= take
                if left[s]:
                    heapq.heappush(rooms[left[s]], (total + cost(take), s))
                    update(left[s])
                pieces.append((doc, start, take, used + s, capacity - room))
                start, n = start + take, n - take
        return pieces, used + n_open

    return place


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    linear: float = 1.0,
    quadratic: float = 1 / 8192,
    block_tokens: int = 1_000_000,
    cached: int = 200_000,
    group_bytes: int = 2_000_000,
) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is a file of the tokenizers library whose pre-tokenizer drops white space, so that what stands between spaces can be encoded apart;
    each task keeps the ids of up to ``cached`` such words, and encodes texts in groups of ``group_bytes``. ``quadratic`` is the weight of attention against the rest for one token pair.
    """
    place = _placer()

    def run(batches):
        import json
        import os
        import zlib
        from array import array

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        model = coder.model
        suffix = json.loads(coder.to_str())["model"]["end_of_word_suffix"] or ""
        is_end = np.zeros(coder.get_vocab_size(), bool)
        is_end[[i for t, i in coder.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        known, number = {}, TaskContext.get().partitionId() << 32  # ids of words, as bytes

        def encode(words):
            """Ids of words; what is all letters is one word to the tokenizer too, so such words share a call, or go to the merges as they are."""
            shared, rest = [], []
            for w in words:
                if not w.isalpha():
                    rest.append(w)
                elif w.isascii() and w.islower():
                    known[w] = array("I", [t.id for t in model.tokenize(w)]).tobytes()
                else:
                    shared.append(w)
            for i in range(0, len(shared), 1024):
                part = shared[i : i + 1024]
                ids = coder.encode(" ".join(part), add_special_tokens=False).ids
                ends = (np.flatnonzero(is_end[ids]) + 1).tolist()
                if len(ends) == len(part):
                    known.update((w, array("I", ids[a:b]).tobytes()) for w, a, b in zip(part, [0, *ends[:-1]], ends, strict=True))
                else:
                    rest += part
            for i in range(0, len(rest), 4096):
                part = rest[i : i + 4096]
                known.update((w, array("I", e.ids).tobytes()) for w, e in zip(part, coder.encode_batch_fast(part, add_special_tokens=False), strict=True))

        def ids_of(texts):
            """Ids of each text: different words are encoded once and spread to where they stand."""
            # A word ends where a sign follows a letter. Signs of contractions and special strings are left alone, and so is U+0130: in lower case it ends in a mark that belongs to the signs.
            spaced = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), r"([^\PL\x{130}])([!-&(-/:;=?@\[-`{}~])", r"\1 \2")
            split = pc.split_pattern(spaced, " ")
            coded = split.flatten().dictionary_encode()
            words = [w.lower() if w.isascii() and "|" not in w else w for w in coded.dictionary.to_pylist()]
            need = set(words).difference(known)
            if len(known) + len(need) > cached:
                known.clear()
                need = set(words)
            encode(need)
            parts = list(map(known.__getitem__, words))
            for word in need:
                if len(word) > 64:
                    del known[word]
            lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            flat, begin = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(lengths) - lengths
            places = coded.indices.to_numpy()
            n = lengths[places]
            total = np.concatenate([[0], np.cumsum(n)])
            ids = flat[np.repeat(begin[places] - total[:-1], n) + np.arange(total[-1])].tobytes()
            at = (4 * total[split.offsets.to_numpy() - split.offsets[0].as_py()]).tolist()
            return [ids[x:y] + end for x, y in zip(at[:-1], at[1:], strict=True)]

        def grouped():
            """Texts in groups of some bytes."""
            for batch in batches:
                sizes = pc.binary_length(batch.column(1)).to_numpy()
                at, n = 0, 0
                for i, size in enumerate(sizes.tolist()):
                    n += size
                    if n >= group_bytes or i + 1 == len(sizes):
                        yield batch.column(0).slice(at, i + 1 - at), batch.column(1).slice(at, i + 1 - at)
                        at, n = i + 1, 0

        def packed(names, data):
            nonlocal number
            pieces, used = place([len(b) // 4 for b in data], capacity, linear, quadratic)
            doc, start, length, sequence, offset = map(list, zip(*pieces, strict=True))
            crc = [zlib.crc32(memoryview(data[d])[4 * s : 4 * (s + n)]) for d, s, n in zip(doc, start, length, strict=True)]
            columns = [[names[d] for d in doc], start, length, crc, [len(data[d]) // 4 for d in doc], [number + s for s in sequence], offset]
            number += used
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [id_type, *[pa.int64()] * 6], strict=True)], names=["id", *NAMES])

        id_type, names, data, tokens = None, [], [], 0
        for ids, texts in grouped():
            id_type = ids.type
            for i, b in zip(ids.to_pylist(), ids_of(texts), strict=True):
                names.append(i)
                data.append(b)
                tokens += len(b) // 4
            if tokens >= block_tokens:
                yield packed(names, data)
                names, data, tokens = [], [], 0
        if names:
            yield packed(names, data)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    fields = [T.StructField("id", rows.schema["id"].dataType), *(T.StructField(n, T.LongType()) for n in NAMES)]
    return rows.mapInArrow(run, T.StructType(fields))
