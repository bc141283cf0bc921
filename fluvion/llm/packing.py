"""Packing of documents into sequences of bounded length: dominance reduction, then best fit.

Lengths are whole numbers up to the sequence length, so all that a packing has
to know is how many pieces have each length: one row per length, whatever the
size of the corpus. The histogram is reduced by the dominance rules of Martello
and Toth: wherever one small set of lengths with a given longest piece is at
least as good as every other set that could hold that piece, it is fixed, as
often as the histogram allows. What is left is packed best fit, longest first.
Both give patterns (lengths of one sequence) with their numbers.

Pieces find their places by rank: the k-th piece of a length takes the k-th
place for it. Ranks are local counts of the encoding tasks plus prefix sums over
tasks, so no task sees more than its own pieces.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.llm.wordcuts import ByteWords, Kept, first_cut
from fluvion.session import materialise, ship, tidy

Pattern = tuple[tuple[tuple[int, int], ...], int]
"""Lengths of one sequence, longest first, each with its number; and how many such sequences."""


def pattern(lengths: list[int]) -> tuple[tuple[int, int], ...]:
    return tuple(sorted(Counter(lengths).items(), reverse=True))


class Lengths:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.n = {v: c for v, c in counts.items() if c > 0}
        self.sorted = sorted(self.n)

    def take(self, lengths: list[int]) -> int:
        """Take as many copies of a set as there are; returns their number."""
        need = Counter(lengths)
        times = min(self.n[v] // c for v, c in need.items())
        for v, c in need.items():
            self.n[v] -= times * c
            if not self.n[v]:
                del self.n[v]
                del self.sorted[bisect_left(self.sorted, v)]
        return times

    def smallest(self, k: int, without: int, above: int = 0, below: int = 1 << 60) -> list[int]:
        """The k smallest pieces between two lengths, one piece of ``without`` left out; fewer if there are no more."""
        out: list[int] = []
        for i in range(bisect_left(self.sorted, above + 1), len(self.sorted)):
            v = self.sorted[i]
            if len(out) >= k or v >= below:
                break
            out += [v] * min(k - len(out), self.n[v] - (v == without))
        return out

    def largest_up_to(self, limit: int, without: Counter) -> int:
        """The longest piece of at most ``limit`` beside the pieces in ``without``; 0 if there is none."""
        for i in range(bisect_left(self.sorted, limit + 1) - 1, -1, -1):
            if self.n[self.sorted[i]] > without[self.sorted[i]]:
                return self.sorted[i]
        return 0


def dominating(left: Lengths, j: int, capacity: int) -> list[int] | None:
    """A set with the piece ``j`` that is at least as good as every set that could hold it, or None if the rules find none.

    One set is as good as another if the other's pieces can be put, group by
    group, under its own. Let room be what ``j`` leaves.

    * Nothing fits beside ``j``: it stays alone.
    * The longest that fits fills the room exactly, or no two others fit
      together: those two.
    * At most two others fit together: the longest that fits, if it is as long
      as the best pair; or the best pair, if the longest that fits is in it and
      no two pieces between its members fit together.
    """
    room = capacity - j
    longest = left.largest_up_to(room, Counter([j]))
    if not longest:
        return [j]
    small = left.smallest(3, without=j)
    if longest == room or len(small) < 2 or small[0] + small[1] > room:
        return [j, longest]
    if len(small) == 3 and sum(small) <= room:
        return None
    best = (0, 0, 0)
    for a in left.sorted[: bisect_left(left.sorted, room + 1)]:
        if left.n[a] > (a == j):
            b = left.largest_up_to(min(a, room - a), Counter([j, a]))
            best = max(best, (a + b, a, b)) if b else best
    total, a, b = best
    if longest >= total:
        return [j, longest]
    if a == longest:
        between = left.smallest(2, without=j, above=b, below=a)
        if len(between) < 2 or sum(between) > room:
            return [j, a, b]
    return None


def reduce_lengths(left: Lengths, capacity: int) -> list[Pattern]:
    """Fix dominating sets, longest piece first, until no rule finds one; takes them from ``left``."""
    fixed, again = [], True
    while again:
        again = False
        for j in reversed(left.sorted.copy()):
            # A set that dominates stays so while pieces are taken: fewer other sets are possible.
            while j in left.n and (best := dominating(left, j, capacity)):
                fixed.append((pattern(best), left.take(best)))
                again = True
    return fixed


def best_fit(left: Lengths, capacity: int) -> list[Pattern]:
    """Longest first, each piece into the fullest open sequence that takes it; equal sequences are filled together."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, held: tuple[int, ...], n: int) -> None:
        if room not in open_:
            insort(rooms, room)
        open_.setdefault(room, []).append((held, n))

    for v in reversed(left.sorted):
        n = left.n[v]
        while n:
            at = bisect_left(rooms, v)
            if at < len(rooms):
                room = rooms[at]
                held, m = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, held, m = capacity, (), n
            # What is left of the fullest sequence is the fullest again, as long as a piece fits.
            each = room // v
            full = min(m, n // each)
            rest = n - full * each if full < m else 0
            for k, some in ((each, full), (rest, 1 if rest else 0), (0, m - full - (rest > 0))):
                if some and (k or held):
                    put(room - k * v, held + (v,) * k, some)
            n -= full * each + rest
    left.n, left.sorted = {}, []
    return [(pattern(list(held)), n) for groups in open_.values() for held, n in groups]


def pack_lengths(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold every piece of a histogram once."""
    if any(v < 1 or v > capacity for v in counts):
        raise ValueError(f"lengths have to be between 1 and {capacity}")
    left = Lengths(counts)
    return reduce_lengths(left, capacity) + best_fit(left, capacity)


def places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, pieces a sequence, offset of the first) for each pattern and length."""
    out, ranks, sequence = [], Counter(), 0
    for lengths, times in patterns:
        offset = 0
        for v, n in lengths:
            out.append((v, ranks[v], ranks[v] + n * times, sequence, n, offset))
            ranks[v] += n * times
            offset += v * n
        sequence += times
    return out


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with part, length and local: the rank of a row among those of its part and length) plus sequence_id and offset.

    The driver gets one row per length, at most ``capacity``, and sends back the
    places: their number depends on the lengths that occur, not on the pieces.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("_n"))
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    table = spark.createDataFrame(places(pack_lengths(total, capacity)), "_length long, _from long, _to long, _first long, _each long, _offset long")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("_rank", F.col("_base") + F.col("local"))
    placed = ranked.join(F.broadcast(table), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    at = F.col("_rank") - F.col("_from")
    named = [F.col(c) for c in pieces.columns if c not in ("part", "local")]
    return placed.select(*named, (F.col("_first") + F.floor(at / F.col("_each"))).alias("sequence_id"), (F.col("_offset") + F.pmod(at, F.col("_each")) * F.col("length")).alias("offset"))


class DocumentEncoder:
    """Ids of whole texts, through kept words where the tokenizer file allows it."""

    def __init__(self, path: str):
        self.words = ByteWords(path, plain_specials=False)
        self.kept, self.first = Kept(self.words.encode_word, 500_000), Kept(lambda text: self.words.encode([text])[0], 20_000)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.words.cuts_safely:
            return self.words.encode(texts)
        first, kept = self.first.__getitem__, self.kept.__getitem__
        return [first(start) + b"".join(map(kept, keys)) for start, keys in map(first_cut, texts)]


_encoders: dict[str, DocumentEncoder] = {}
#: Texts given to the encoder at once, and bytes of ids after which a batch is sent.
ENCODE_ROWS, SEND_BYTES = 200, 1 << 22
PIECES = "part int, doc_id long, piece int, start long, length long, local long, ids binary"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids of every text and its end id; of a longer document the first piece takes what full ones leave.

    Also the task (part) and a row's rank among those of its task and length.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _encoders:
            _encoders[tokenizer_path] = DocumentEncoder(tokenizer_path)
        tail, seen = np.array([end_id], dtype="<u4").tobytes(), Counter()
        out: list[tuple] = []
        held = part = 0

        def send() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array([part] * len(out), pa.int32()), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "doc_id", "piece", "start", "length", "local", "ids"])

        for batch in batches:
            for at in range(0, batch.num_rows, ENCODE_ROWS):
                some = batch.slice(at, ENCODE_ROWS)
                part = some.column(0)[0].as_py()
                for i, data in zip(some.column(1).to_pylist(), _encoders[tokenizer_path].encode(some.column(2).to_pylist()), strict=True):
                    data += tail
                    n = len(data) // 4
                    cuts = [0, *range(n % capacity or capacity, n, capacity), n]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        out.append((i, k, a, b - a, seen[b - a], data[4 * a : 4 * b]))
                        seen[b - a] += 1
                    held += len(data)
                    if held > SEND_BYTES:
                        yield send()
                        out, held = [], 0
        if out:
            yield send()

    return rows.mapInArrow(tidy(encode), PIECES)


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Every piece of every document with its ids, their CRC-32, its sequence and its offset there.

    Null texts count as empty and are the end id alone; repeated rows are packed
    each by itself; only documents longer than a sequence are cut. Among pieces
    of equal length the order of input decides. An empty table gives no rows;
    other columns are ignored. A text of any length is encoded by itself and
    sent on piece by piece.
    """
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col).withColumn("ids_crc32", F.crc32("ids"))
    written = materialise(pieces, "pieces")
    return pack_pieces(written if with_ids else written.drop("ids"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids, joined in order of offset, and how many."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("_held"))
    return held.select("sequence_id", F.aggregate("_held", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("length"), F.aggregate("_held", F.lit(b"").cast("binary"), lambda joined, p: F.concat(joined, p["ids"])).alias("ids"))
