"""SentencePiece encoding by sampling without replacement, and decoding.

A text's segmentations form a lattice over the model's pieces; each piece has
the weight of a Zipf law of its rank, so a segmentation's log-probability is a
sum. Gumbel top-k draws k distinct segmentations: every segmentation has a
perturbed score (log-probability plus Gumbel noise) and the k largest are
wanted. An A*-like search finds them without listing any others. The root set
of all segmentations has a Gumbel score; following a path splits a set, at each
lattice state, into the edge taken, which inherits the set's score, and the
edges left, whose best score is a Gumbel truncated at it. The set with the best
score is expanded next. All draws come from a counter-based generator seeded by
the row's key, so a row gives the same samples wherever and however often it is
encoded.

No piece of the model goes on from a letter to another sign, or the other way
round, or over a digit or a line feed; only space marks lead a piece. So a text
is cut into units at those places (which is checked when a model is read). The
lattice of each distinct unit of a batch is built once, and one pass samples
all units of all texts, edge by edge.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.llm.mixing import mix
from fluvion.session import ship, tidy

#: Segmentations of each text.
SAMPLES = 2
#: Characters of the texts that are encoded together, about, and longest piece.
CHARS, LONGEST = 500_000, 16
SPACE = "▁"
#: Space marks with the letters or with the other signs that follow; digits and line feeds each by itself.
UNIT = re.compile(rf"{SPACE}*[^\W\d_¹²³]+|[0-9\n]|{SPACE}*(?:(?![{SPACE}\n0-9])[\W\d_¹²³])+|{SPACE}+")
#: Codes of the bytes of characters without a piece, past all code points.
BYTES_FROM = 0x110000
#: What the hash table says of strings that are no piece.
PREFIX, ABSENT = -2, -1
#: Log-probabilities are summed as whole multiples of one part in so many.
FIXED = float(1 << 32)
_STEP, _WORD, _PASS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x165667B19E3779F9), 0xC2B2AE3D27D4EB4F


def keyed(seed: np.ndarray, unit: np.ndarray, stream: int) -> np.ndarray:
    """One key for each seed and unit; streams are independent."""
    return mix(mix(seed + np.uint64(stream * _PASS % (1 << 64))) + unit.astype(np.uint64) * _STEP)


def uniform(key: np.ndarray, step: np.ndarray | int) -> np.ndarray:
    """Draws in (0, 1) for each key and step, which is mixed in by itself: no two places of a text share a draw."""
    x = mix(key + np.atleast_1d(step).astype(np.uint64) * _WORD + _WORD)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def truncated(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel draws with a location, conditioned to lie below a bound."""
    return location - np.logaddexp(location - bound, np.log(-np.log(u)))


class Pieces:
    """The vocabulary of a SentencePiece model: piece bytes, log-weights and a hash table from strings to ids."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes: list[bytes] = []
        self.byte_ids = np.zeros(256, dtype=np.int64)
        weight, keys, ids = np.full(n, -12.0), [], []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes.append(bytes([value]))
                continue
            self.bytes.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(SPACE, " ").encode())
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            weight[i] = -np.log(2.0 + max(0.0, -model.get_score(i)))
            keys.append(piece)
            ids.append(i)
        self.weight = weight - np.log(np.exp(weight[ids]).sum())
        # PREFIX and ABSENT count from the end.
        self.edge_weight = np.concatenate([self.weight, [-np.inf, -np.inf]])
        self.known = np.zeros(BYTES_FROM + 256, dtype=bool)
        self.known[[ord(k) for k in keys if len(k) == 1]] = True
        self.known[BYTES_FROM:] = True
        if crossing := next((k for k in keys if UNIT.fullmatch(k) is None), None):
            raise ValueError(f"piece {crossing!r} of this model crosses unit borders")
        codes = [[ord(c) for c in k] for k in keys] + [[BYTES_FROM + b] for b in range(256)]
        found = dict(zip(map(tuple, codes), ids + self.byte_ids.tolist(), strict=True))
        for code in codes:
            for end in range(1, len(code)):
                found.setdefault(tuple(code[:end]), PREFIX)
        self.size = 1 << 20
        self.keys, self.ids = np.zeros(self.size + 64, dtype=np.uint64), np.full(self.size + 64, ABSENT, dtype=np.int32)
        for code, v in found.items():
            at = (h := self.hash_of(code)) % self.size
            while self.ids[at] != ABSENT:
                at += 1
            self.keys[at], self.ids[at] = h, v
        sizes = np.array([len(x) for x in self.bytes])
        self.spelt = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.spelt_at, self.spelt_size = np.cumsum(sizes) - sizes, sizes

    @staticmethod
    def hash_of(codes: tuple[int, ...]) -> int:
        h = np.zeros(1, dtype=np.uint64)
        for c in codes:
            h = mix(h + np.uint64(c + 1))
        return int(h[0])

    def find(self, h: np.ndarray) -> np.ndarray:
        """Ids of hashed strings; PREFIX where only longer strings are pieces, ABSENT where nothing is."""
        at = (h & np.uint64(self.size - 1)).astype(np.int64)
        out = self.ids[at]
        other = np.nonzero((self.keys[at] != h) & (out != ABSENT))[0]
        out[other] = ABSENT
        at = at[other]
        while len(other):
            at = at + 1
            here = self.ids[at]
            hit = self.keys[at] == h[other]
            out[other[hit]] = here[hit]
            going = ~hit & (here != ABSENT)
            other, at = other[going], at[going]
        return out

    def codes(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of all units in a row, and how many each has; a character without a piece becomes its UTF-8 bytes."""
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        strange = ~self.known[points]
        if not strange.any():
            return points, sizes
        width = np.where(strange, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), 1)
        total = np.concatenate([[0], np.cumsum(width)])
        out = np.repeat(points, width)
        for c in np.unique(points[strange]).tolist():
            spelt = np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64) + BYTES_FROM
            out[(total[:-1][points == c][:, None] + np.arange(len(spelt)))] = spelt
        ends = np.cumsum(sizes)
        return out, total[ends] - total[ends - sizes]

    def spell(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids in a row, and where each id's bytes end."""
        sizes = self.spelt_size[ids]
        ends = np.cumsum(sizes)
        return self.spelt[np.repeat(self.spelt_at[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes(), ends

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the first piece's leading space is the encoder's own."""
        text = b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Lattice:
    """Lattices of distinct units, one state for each distance from a unit's end.

    Units are numbered by falling size, so the units that have a state at
    distance d are 0 to ``held[d] - 1``. State (d, unit) owns ``reach(d)``
    entries in a row from ``at(d, unit)``: entry j is the piece of j + 1 signs.
    """

    def __init__(self, pieces: Pieces, units: list[str]):
        plain, sizes = pieces.codes(units)
        order = np.argsort(-sizes, kind="stable")
        #: Number of each unit in the order given.
        self.number = np.empty(len(units), dtype=np.int64)
        self.number[order] = np.arange(len(units))
        self.size = sizes[order]
        longest = int(sizes.max(initial=0))
        distances = np.arange(longest + 1)
        held = np.searchsorted(-self.size, -distances, side="right")
        self.base = np.concatenate([[0], np.cumsum((held * np.minimum(distances, LONGEST))[1:])])
        self.base = np.concatenate([[0], self.base])[: longest + 2]
        n = len(plain)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
        entry = self.at(left, np.repeat(self.number, sizes))
        plain = (plain + 1).astype(np.uint64)
        #: The piece of each entry, or a negative number.
        self.piece = np.full(int(self.base[-1]), ABSENT, dtype=np.int32)
        alive, h = np.arange(n), np.zeros(n, dtype=np.uint64)
        for k in range(min(LONGEST, longest)):
            h = mix(h + plain[alive + k])
            found = pieces.find(h)
            self.piece[entry[alive] + k] = found
            longer = (found != ABSENT) & (left[alive] > k + 1)
            alive, h = alive[longer], h[longer]
        weight = pieces.edge_weight[self.piece]
        self.log_share, self.cumulated = np.empty(len(weight)), np.empty(len(weight))
        # Log-sums of all ways to the unit's end, for all states at one distance from it at once.
        ways = [np.zeros(len(units))]
        for d in range(1, longest + 1):
            span, m = slice(self.base[d], self.base[d + 1]), held[d]
            sums = weight[span].reshape(m, -1)
            for j in range(sums.shape[1]):
                sums[:, j] += ways[-1 - j][:m]
            top = sums.max(axis=1)
            chance = np.exp(sums - top[:, None])
            total = chance.sum(axis=1)
            ways.append(top + np.log(total))
            if len(ways) > LONGEST:
                del ways[0]
            self.log_share[span] = np.minimum(sums - ways[-1][:, None], 0.0).ravel()
            chance = np.cumsum(chance, axis=1)
            self.cumulated[span] = (chance / chance[:, -1:]).ravel()

    @staticmethod
    def reach(distance: np.ndarray) -> np.ndarray:
        return np.minimum(distance, LONGEST)

    def at(self, distance: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """The first entry of each state."""
        return self.base[distance] + unit * self.reach(distance)

    def take(self, first: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The entries, counted from each state's first, that draws ``u`` choose."""
        j, open_ = np.zeros(len(u), dtype=np.int64), np.arange(len(u))
        while len(open_):
            open_ = open_[self.cumulated[first[open_] + j[open_]] <= u[open_]]
            j[open_] += 1
        return j

    def rest(self, distance: int, unit: int, taken: tuple[int, ...]) -> list[int]:
        """Entries of one state that are pieces, but for those taken."""
        first = int(self.at(np.int64(distance), np.int64(unit)))
        return [e for e in range(first, first + min(distance, LONGEST)) if self.piece[e] >= 0 and e not in taken]


def log_complement(log_share: np.ndarray) -> np.ndarray:
    """log(1 - exp(x)), -inf for a share of one."""
    with np.errstate(divide="ignore"):
        return np.log(-np.expm1(np.minimum(log_share, 0.0)))


class Sampler:
    """Gumbel top-k segmentations of texts."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)

    def walk(self, lattice: Lattice, doc, place, unit, distance, seed, stream):
        """Sample pieces from ``distance`` to the end of each unit instance; ``place`` is a unit's place in its text.

        Returns, for each step: instance, step number, distance, entry.
        """
        key = keyed(seed[doc], place, stream)
        live, step, out = np.arange(len(unit)), 0, []
        while len(live):
            first = lattice.at(distance, unit)
            j = np.zeros(len(live), dtype=np.int64)
            open_ = np.nonzero(distance > 1)[0]
            j[open_] = lattice.take(first[open_], uniform(key[live[open_]], step))
            out.append((live, np.full(len(live), step), distance, first + j))
            distance = distance - j - 1
            more = distance > 0
            live, unit, distance, step = live[more], unit[more], distance[more], step + 1
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4

    def sample(self, texts: list[str], seeds: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float]]]:
        """For each text its samples, best perturbed score first: (ids, log-probability, inclusion probability).

        A text with fewer than k segmentations gives all of them; an empty text gives one without ids.
        """
        split = [UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        every = list(chain.from_iterable(split))
        index = {u: i for i, u in enumerate(dict.fromkeys(every))}
        flat = np.fromiter(map(index.__getitem__, every), dtype=np.int64, count=len(every))
        counts = np.array([len(x) for x in split], dtype=np.int64)
        doc = np.repeat(np.arange(len(texts)), counts)
        first_unit = np.cumsum(counts) - counts
        unit = np.arange(len(flat)) - first_unit[doc]
        lattice = Lattice(self.pieces, list(index))
        kind = lattice.number[flat]
        n = len(texts)
        root = -np.log(-np.log(uniform(keyed(seeds, np.zeros(n, np.int64), 1), 0)))
        samples: list[list] = [[] for _ in texts]
        heaps: list[list] = [[] for _ in texts]
        # Turn 0 starts every text at its first unit; later turns start inside a unit, after a prefix of an earlier sample.
        todo = [(i, root[i], 0.0, None) for i in range(n)]
        for turn in range(k):
            bound, base = np.full(n, -np.inf), np.zeros(n)
            begin, begin_distance = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            lead = np.zeros(n, dtype=np.int64)
            for i, score, before, cut in todo:
                bound[i], base[i] = score, before
                begin[i] = 0
                if cut is not None:
                    lead[i], begin[i], begin_distance[i] = len(cut[0]), cut[1], cut[2]
            inst = np.nonzero((unit > begin[doc]) | ((unit == begin[doc]) & (begin_distance[doc] != 0)))[0]
            d, un = doc[inst], unit[inst]
            distance = lattice.size[kind[inst]]
            resumed = (un == begin[d]) & (begin_distance[d] > 0)
            distance[resumed] = begin_distance[d[resumed]]
            who, step, at_distance, entry = self.walk(lattice, d, un, kind[inst], distance, seeds, 10 + 4 * turn)
            # Order the steps by text, unit and step; then prefix sums run along each path.
            lengths = np.bincount(who, minlength=len(inst)).astype(np.int64)
            starts = np.cumsum(lengths) - lengths
            place = starts[who] + step
            path, left = np.empty(len(entry), dtype=np.int64), np.empty(len(entry), dtype=np.int64)
            path[place], left[place] = entry, at_distance
            of = np.repeat(np.arange(len(inst)), lengths)
            owner = d[of] if len(of) else np.zeros(0, np.int64)
            share = lattice.log_share[path]
            # Whole numbers sum alike in any order, so a text's sums do not depend on its batch.
            run = np.cumsum(np.rint(share * FIXED).astype(np.int64))
            tokens = np.bincount(owner, minlength=n).astype(np.int64)
            head = np.cumsum(tokens) - tokens
            start_sum = np.concatenate([[0], run])[head]
            several = np.nonzero(share < 0)[0]
            holder = owner[several]
            along = (np.concatenate([[0], run])[several] - start_sum[holder]) / FIXED + base[holder]
            u = uniform(keyed(seeds[holder], un[of[several]], 12 + 4 * turn), several - starts[of[several]])
            best = truncated(along + log_complement(share[several]), bound[holder], u)
            ids = lattice.piece[path]
            for i, score, before, cut in todo:
                a, b = head[i], head[i] + tokens[i]
                whole = np.concatenate([cut[0], ids[a:b]]) if cut is not None else ids[a:b]
                samples[i].append((whole, float(before + ((run[b - 1] - start_sum[i]) / FIXED if b > a else 0.0)), score))
            if turn == k - 1:
                # The best set left aside bounds what another sample would have scored.
                for j in self.tops(holder, best, n, 1):
                    heapq.heappush(heaps[int(holder[j])], (-float(best[j]), turn))
                break
            # The k best sets that each path leaves aside, with what is needed to go on from there.
            for j in self.tops(holder, best, n, k - turn):
                p, i = int(several[j]), int(holder[j])
                heapq.heappush(heaps[i], (-float(best[j]), turn, p, float(along[j]), samples[i][-1][0][: lead[i] + p - head[i]], int(un[of[p]]), int(kind[inst[of[p]]]), int(left[p]), (int(path[p]),)))
            todo = []
            for i in range(n):
                if not heaps[i]:
                    continue
                score, _, _, before, ids_before, at_unit, of_kind, at, taken = heapq.heappop(heaps[i])
                score = -score
                rest = lattice.rest(at, of_kind, taken)
                share_rest = lattice.log_share[rest]
                # One set is split at each turn.
                u, v = uniform(keyed(seeds[[i, i]], np.zeros(2, np.int64), 13 + 4 * turn), np.arange(2))
                cumulated = np.cumsum(np.exp(share_rest - share_rest.max()))
                chosen = min(int(np.searchsorted(cumulated, u * cumulated[-1], side="right")), len(rest) - 1)
                others = [x for j, x in enumerate(share_rest) if j != chosen]
                if others:
                    left_score = truncated(np.array([before + np.logaddexp.reduce(others)]), np.array([score]), v)[0]
                    heapq.heappush(heaps[i], (-float(left_score), turn, -1, before, ids_before, at_unit, of_kind, at, (*taken, rest[chosen])))
                first = int(lattice.at(np.int64(at), np.int64(of_kind)))
                new_ids = np.append(ids_before, lattice.piece[rest[chosen]])
                todo.append((i, score, before + float(share_rest[chosen]), (new_ids, at_unit, at - (rest[chosen] - first) - 1)))
            if not todo:
                break
        out = []
        for i in range(n):
            limit = -heaps[i][0][0] if heaps[i] else -np.inf
            out.append([(ids, logp, float(-np.expm1(-np.exp(min(logp - limit, 50.0)))) if np.isfinite(limit) else 1.0) for ids, logp, _ in samples[i]])
        return out

    @staticmethod
    def tops(owner: np.ndarray, value: np.ndarray, n: int, k: int) -> list[int]:
        """Places of the k largest finite values of each owner."""
        out: list[int] = []
        value = value.copy()
        for _ in range(k):
            top = np.full(n, -np.inf)
            np.maximum.at(top, owner, value)
            hit = np.nonzero((value == top[owner]) & np.isfinite(value))[0]
            hit = hit[np.unique(owner[hit], return_index=True)[1]]
            out += hit.tolist()
            value[hit] = -np.inf
        return out


_samplers: dict[str, Sampler] = {}


def sampler(path: str) -> Sampler:
    """One sampler for each Python worker and model."""
    if path not in _samplers:
        _samplers[path] = Sampler(path)
    return _samplers[path]


def sample_pieces(docs: DataFrame, model_path: str, k: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per input row with its samples, best first, as arrays.

    doc_id; n_samples; n_tokens and ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers); log_prob; inclusion (the chance that the sample
    is among the k, given the best score left out); round_trip (every sample
    decodes to the text and no two are equal); with ``with_ids`` the ids too.
    A null or empty text has one sample without ids. Texts that hold U+2581
    decode to spaces there, so round_trip is false. Repeated rows get equal
    samples, as the seed is their key (a null key is one key). An empty table
    gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(model_path)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            start = 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size + len(texts[stop]) <= CHARS):
                    size += len(texts[stop])
                    stop += 1
                some = texts[start:stop]
                seeds = np.array([xxhash.xxh3_64_intdigest(str(x)) for x in keys[start:stop]], dtype=np.uint64)
                found = own.sample(some, seeds, k)
                flat = np.concatenate([x[0] for x in chain.from_iterable(found)] or [np.zeros(0, np.int32)]).astype("<i4")
                sizes = np.fromiter((len(x[0]) for x in chain.from_iterable(found)), dtype=np.int64)
                ends = np.cumsum(sizes)
                held, (spelt, piece_ends) = flat.tobytes(), own.pieces.spell(flat)
                byte_ends = np.concatenate([[0], piece_ends])[ends]
                byte_starts = np.concatenate([[0], piece_ends])[ends - sizes]
                fine, crcs, j = [], [], 0
                for text, samples in zip(some, found, strict=True):
                    whole, data, same = b" " + text.encode("utf-8", "surrogatepass") if text else b"", [], True
                    for _ in samples:
                        data.append(held[4 * (ends[j] - sizes[j]) : 4 * ends[j]])
                        same &= spelt[byte_starts[j] : byte_ends[j]] == whole
                        j += 1
                    crcs.append([zlib.crc32(x) for x in data])
                    fine.append(same and len(set(data)) == len(data))
                columns = [
                    batch.column(0).slice(start, stop - start),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array([[len(x[0]) for x in s] for s in found], pa.list_(pa.int64())),
                    pa.array(crcs, pa.list_(pa.int64())),
                    pa.array([[x[1] for x in s] for s in found], pa.list_(pa.float64())),
                    pa.array([[x[2] for x in s] for s in found], pa.list_(pa.float64())),
                    pa.array(fine, pa.bool_()),
                ]
                names = ["doc_id", "n_samples", "n_tokens", "ids_crc32", "log_prob", "inclusion", "round_trip"]
                if with_ids:
                    inner = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))
                    columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), inner))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                start = stop

    schema = f"doc_id {kind}, n_samples long, n_tokens array<long>, ids_crc32 array<long>, log_prob array<double>, inclusion array<double>, round_trip boolean"
    return rows.mapInArrow(tidy(encode), schema + (", ids array<array<int>>" if with_ids else ""))
