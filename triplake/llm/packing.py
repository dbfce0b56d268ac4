"""Best-two-fit packing of token pieces into sequences.

Texts become token ids; longer ones than a sequence are cut, so that all pieces but the first are full. How full
sequences are packed depends on lengths alone, so the plan is made from the number of pieces of each length: at most
`capacity` counts, however many pieces there are. A bin is filled greedily (the longest length left that fits, again
and again); then its smallest piece is replaced by two lengths that are left and fill the gap, widened by that piece,
more tightly; and again while that helps. A bin's pattern is used as often as the counts allow at once, so the plan has
few patterns. Pieces then find their places by their rank among the pieces of their length: ranks come from counts of
hashed shares of each length, so that a length that many pieces have is ranked by many tasks.

A special token's string in a text is that token, as tokenizers has it by default.

Defined results: null and empty texts are one piece of the end token; repeated rows are packed each for itself (they
are told apart by their number among equals); rows with a null id too; other columns play no part; an empty table gives
an empty result.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triplake.llm.shared import stored

CAPACITY = 2048
END = 0

#: Shares of a length that are ranked apart.
SHARES = 64

#: The piece splitting of the vocabulary's public definition (fixed value).
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

#: The vocabulary's one special token and its id (fixed value of its public definition).
SPECIAL = {"<|endoftext|>": 50256}


@lru_cache(maxsize=4)
def encoder(ranks_path: str):
    """The byte-level vocabulary in ranks_path as tiktoken reads it; its ids are those of the same vocabulary in tokenizers."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=SPECIAL)


#: White space as the splitting knows it, in runs that may be too long for it to go back over.
_GAP = re.compile("[{0}]{{1000,}}(?=[^{0}])".format("\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"))


def token_ids(ranks_path: str, text: str) -> list[int]:
    """The text's ids, also where a run of white space is longer than the splitting can take.

    Such a run is one piece but for its last character, which goes with what follows; before the special token, or at the
    end of the text, it is one piece as a whole. Cutting the text there leaves the pieces as they are.
    """
    encode = partial(encoder(ranks_path).encode, allowed_special="all")
    try:
        return encode(text)
    except ValueError:
        out, at = [], 0
        for gap in _GAP.finditer(text):
            end = gap.end() if any(text.startswith(special, gap.end()) for special in SPECIAL) else gap.end() - 1
            out += encode(text[at:end])
            at = end
        return out + encode(text[at:])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and token_ids) of every document."""

    def tokenised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text, strict=True):
                ids = np.array([*token_ids(ranks_path, text or ""), END], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(part.tobytes()), *([part.astype(np.int64)] if with_ids else [])))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["token_ids"] if with_ids else [])]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out.doc_id.astype("Int64")
            yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", token_ids array<long>" * with_ids
    return docs.select("doc_id", "text").mapInPandas(tokenised, schema)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(times, lengths) of each pattern of bins; counts[n] pieces have length n."""
    left = counts.astype(np.int64).copy()
    alive = [int(n) for n in np.flatnonzero(left)]
    out = []

    def fitting(room: int, used: dict[int, int]) -> int:
        """The longest length up to room of which there is one more than used; 0 if none."""
        at = bisect.bisect_right(alive, room) - 1
        while at >= 0 and left[alive[at]] <= used.get(alive[at], 0):
            at -= 1
        return alive[at] if at >= 0 else 0

    def best_two(room: int, used: dict[int, int]) -> tuple[int, int]:
        """Two lengths that are left with the largest sum up to room."""
        best = (0, 0)
        low, high = 0, bisect.bisect_right(alive, room) - 1
        free = lambda n, more=0: left[n] - used.get(n, 0) > more
        while low <= high:
            a, b = alive[low], alive[high]
            if not free(b):
                high -= 1
            elif not free(a):
                low += 1
            elif a + b > room:
                high -= 1
            else:
                if a + b > sum(best) and (a != b or free(a, 1)):
                    best = (a, b)
                    if a + b == room:
                        break
                low += 1
        return best

    while alive:
        used: dict[int, int] = {}
        bin_: list[int] = []
        room = capacity
        while n := fitting(room, used):
            bin_.append(n)
            used[n] = used.get(n, 0) + 1
            room -= n
        while room and bin_:
            smallest = min(bin_)
            two = best_two(room + smallest, used)
            if sum(two) <= smallest:
                break
            bin_.remove(smallest)
            used[smallest] -= 1
            for n in two:
                bin_.append(n)
                used[n] = used.get(n, 0) + 1
            room -= sum(two) - smallest
        used = {n: k for n, k in used.items() if k}
        times = min(int(left[n]) // k for n, k in used.items())
        for n, k in used.items():
            left[n] -= times * k
            if not left[n]:
                alive.remove(n)
        out.append((times, sorted(bin_, reverse=True)))
    return out


class Places:
    """Of each length, the ranks at which a pattern's pieces begin, and where they go."""

    def __init__(self, patterns: list[tuple[int, list[int]]]):
        self.at: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        sequence = 0
        for times, bin_ in patterns:
            offset = 0
            for n in dict.fromkeys(bin_):
                each = bin_.count(n)
                self.at.setdefault(n, []).append((taken.get(n, 0), each, sequence, offset))
                taken[n] = taken.get(n, 0) + times * each
                offset += each * n
            sequence += times
        self.tables = {n: np.array(rows, dtype=np.int64).T for n, rows in self.at.items()}

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            if not len(rows):
                continue
            n = int(lengths[rows[0]])
            first, each, base, place = self.tables[n]
            k = np.searchsorted(first, ranks[rows], side="right") - 1
            within = ranks[rows] - first[k]
            sequence[rows] = base[k] + within // each[k]
            offset[rows] = place[k] + within % each[k] * n
        return sequence, offset


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """found (a stored table of pieces with `length`) with sequence_id and offset."""
    spark = found.sparkSession
    key = [F.col(c) for c in found.columns if c != "token_ids"]
    dealt = found.withColumn("_share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SHARES)))
    sizes = dealt.groupBy("length", "_share").agg(F.count(F.lit(1)).alias("n"))
    # At most capacity x SHARES numbers.
    table = sizes.toPandas().sort_values(["length", "_share"])
    if table.empty:
        return found.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).limit(0)
    before = np.zeros((capacity + 1, SHARES + 1), np.int64)
    before[table.length.to_numpy(), table._share.to_numpy() + 1] = table.n.to_numpy()
    before = before.cumsum(axis=1)
    places = spark.sparkContext.broadcast((before[:, :-1], Places(plan(before[:, -1], capacity))))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_share").orderBy(*key)) - 1)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begins, found_at = places.value
        for batch in batches:
            lengths = batch.length.to_numpy()
            ranks = begins[lengths, batch._share.to_numpy()] + batch._rank.to_numpy()
            batch["sequence_id"], batch["offset"] = found_at.find(lengths, ranks)
            yield batch.drop(columns=["_share", "_rank"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return ranked.mapInPandas(placed, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, (token_ids,) sequence_id, offset."""
    return pack(stored(pieces(docs, ranks_path, capacity, with_ids)), capacity)
