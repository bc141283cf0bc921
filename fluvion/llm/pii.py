"""Personal data: fixed patterns, and a skip-chain conditional random field for consistency across a document.

The fixed patterns label most mentions. A mention is a token with a digit or an
@, or a word with an inner mark that is the local part of an address in the
document, labelled with a kind or as other. The field has one potential for a
mention's own features, one for neighbours in the text, and one for distant
mentions that are equal or similar (the same token, the same last digits, the
same local part). Similar mentions meet at a hub with a label of its own, so n of them
need n edges, never n * n. Loopy message passing then carries a label from a
mention that the patterns know to a repeat that they do not, and features can
name a mention that no pattern takes. All potentials are fitted together by
pseudo-likelihood; every example is shown three times, whole, without the sign
that gives its pattern away, and by its neighbours alone, so that each part
learns its weight though another may explain the label by itself.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.session import materialise, ship, tidy

KINDS = ("email", "ip", "card", "phone")
LABELS = (*KINDS, "other")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can start only where a run of digits does: if it fails there, it fails inside the run too.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Documents the potentials are learned from, about; rounds of message passing at most, and the change that ends them; belief that a new span needs.
TRAIN_DOCS, ROUNDS, SETTLED, BELIEF = 20_000, 60, 1e-6, 0.8
#: Steps and ridge of the fit.
FIT_STEPS, RIDGE = 400, 0.5
DIGIT_OR_AT, DIGIT = re.compile("[0-9@]"), re.compile("[0-9]")
#: A word before a colon or an equals sign that names what follows.
NAMING = re.compile(r"([A-Za-z-]{1,20})\x20?[:=]\x20?\Z")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: What is not part of a token at its ends.
MARKS = ".,;:!?()[]{}\"'<>"
#: A word with an inner mark. An underscore is a mark and a word's character; each character fits one place only, so a match takes linear time.
PARTED = re.compile(r"(?=[\w.%+-]*?(?:[.%+-]|_\w))[^\W\d_](?:\w|[.%+-]\w)*")
#: Digits by which two numbers are similar.
TAIL_DIGITS = 7


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards, so that a long run without one costs nothing."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind as listed, then start."""
    found = [("email", a, b) for a, b in emails(text)]
    if not DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]


def joined(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by kind as listed, then start."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), *s[1:])))


@dataclass
class Mention:
    start: int
    end: int
    text: str
    #: Number of the known label, or -1.
    label: int
    #: Those that always count, and those that give a pattern away.
    features: tuple[tuple[str, ...], tuple[str, ...]]
    keys: tuple[str, ...]


def features_of(token: str, before: str = "") -> tuple[tuple[str, ...], tuple[str, ...]]:
    """A mention's features: those that always count, and those that give a pattern away.

    ``before`` is the text that leads up to the mention (24 characters are enough for a naming word).
    """
    digits = re.sub("[^0-9]", "", token)
    at = "none" if "@" not in token else "domain" if "." in token.partition("@")[2] else "bare"
    # What is counted is counted apart for words and numbers, with and without an @: a bare word is like no address.
    kind = f"{at}:{min(sum(c.isalpha() for c in token), 1)}"
    plain = [f"kind:{kind}", f"digits:{min(len(digits), 20)}:{kind}", f"marks:{''.join(sorted(set(token) & set('()-/:_%')))}:{kind}"]
    if m := NAMING.search(before):
        plain.append("named:" + m[1].lower())
    if dots := min(token.count("."), 4):
        plain.append(f"dots:{dots}:{kind}:{bool(IP.fullmatch(token)) and all(len(p.lstrip('0')) <= 3 and int(p) <= 255 for p in token.split('.'))}")
    if 13 <= len(digits) <= 19 and kind.endswith("0"):
        plain.append(f"luhn:{luhn(digits)}")
    return tuple(plain), ("plus",) if token.startswith("+") else ()


def keys_of(token: str) -> tuple[str, ...]:
    """What makes mentions similar: the token itself, its dotted address, the last digits of a number, the local part of an address.

    A bare word is similar to an address only if a mark parts it (john.smith): a word alone is no address.
    """
    digits = re.sub("[^0-9]", "", token)
    letters = sum(c.isalpha() for c in token)
    keys = []
    if len(digits) >= TAIL_DIGITS and letters <= 1:
        keys.append("n:" + digits[-TAIL_DIGITS:])
    whole = token.lower().strip(MARKS)
    local = local_part(token)
    if "@" in token or PARTED.fullmatch(local):
        keys.append("a:" + local)
    keys.append("t:" + whole)
    if m := IP.search(token):
        keys.append("i:" + ".".join(p.lstrip("0") or "0" for p in m.groups()))
    return tuple(k for k in keys if len(k) > 2)


def local_part(token: str) -> str:
    """What stands before the first @, or after it where nothing does, lower-cased."""
    before, _, after = token.lower().strip(MARKS).partition("@")
    return (before or after.partition("@")[0]).strip(MARKS)


def mentions(text: str, base: list[tuple[str, int, int]]) -> list[Mention]:
    """Base spans, and all other tokens with a digit, an @ or the parted local part of an address among them, in text order."""
    if not DIGIT_OR_AT.search(text):
        return []

    def mention(a: int, b: int, label: int) -> Mention:
        token = text[a:b]
        return Mention(a, b, token, label, features_of(token, text[max(0, a - 24) : a]), keys_of(token))

    out = [mention(a, b, LABELS.index(k)) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    locals_ = {x for kind, a, b in base if kind == "email" and PARTED.fullmatch(x := local_part(text[a:b]))}
    k, reached = 0, 0
    for m in WORD.finditer(text):
        token = m[0]
        if not DIGIT_OR_AT.search(token) and not (locals_ and token.lower().strip(MARKS) in locals_):
            continue
        a = m.start() + len(token) - len(token.lstrip(MARKS))
        b = m.start() + len(token.rstrip(MARKS))
        while k < len(taken) and taken[k][0] < b:
            reached = max(reached, taken[k][1])
            k += 1
        if a < b and a >= reached:
            out.append(mention(a, b, -1))
    return sorted(out, key=lambda x: (x.start, x.end))


@dataclass
class SkipChain:
    """Log-potentials: of features by label, of neighbouring labels, and of a mention's label given its hub's."""

    unary: dict[str, np.ndarray]
    prior: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def labels(self, found: list[Mention]) -> np.ndarray:
        """Beliefs, mentions by labels, once the messages have settled (after ROUNDS at the latest)."""
        n, size = len(found), len(LABELS)
        own = np.tile(self.prior, (n, 1))
        for i, m in enumerate(found):
            for f in chain(*m.features):
                if (w := self.unary.get(f)) is not None:
                    own[i] += w
            if m.label >= 0:
                own[i] = -30.0
                own[i, m.label] = 0.0
        hubs: dict[str, list[int]] = defaultdict(list)
        for i, m in enumerate(found):
            for key in m.keys:
                hubs[key].append(i)
        # Mentions that share several keys meet once.
        ends = [(i, h) for h, who in enumerate(dict.fromkeys(tuple(w) for w in hubs.values() if len(w) > 1)) for i in who]
        node = np.array([i for i, _ in ends], dtype=np.int64)
        hub = np.array([h for _, h in ends], dtype=np.int64)
        n_hubs = int(hub.max()) + 1 if len(hub) else 0
        up, down = np.zeros((len(ends), size)), np.zeros((len(ends), size))
        right, left = np.zeros((n, size)), np.zeros((n, size))

        def through(message: np.ndarray, table: np.ndarray) -> np.ndarray:
            sent = np.logaddexp.reduce(message[:, :, None] + table[None], axis=1)
            return sent - sent.max(axis=1, keepdims=True)

        for _ in range(ROUNDS):
            belief = own + right + left
            np.add.at(belief, node, down)
            new_up = through(belief[node] - down, self.skip) if len(ends) else up
            total = np.zeros((n_hubs, size))
            np.add.at(total, hub, new_up)
            new_down = through(total[hub] - new_up, self.skip.T) if len(ends) else down
            new_right, new_left = np.zeros((n, size)), np.zeros((n, size))
            if n > 1:
                new_right[1:] = through((belief - left)[:-1], self.chain)
                new_left[:-1] = through((belief - right)[1:], self.chain.T)
            change = max(np.abs(new_down - down).max(initial=0.0), np.abs(new_right - right).max(initial=0.0), np.abs(new_left - left).max(initial=0.0))
            up, down, right, left = new_up, new_down, new_right, new_left
            if change < SETTLED:
                break
        belief = own + right + left
        np.add.at(belief, node, down)
        belief -= belief.max(axis=1, keepdims=True)
        belief = np.exp(belief)
        return belief / belief.sum(axis=1, keepdims=True)

    def spans(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """New spans: mentions outside the base spans that the field believes to be of a kind.

        A mention similar to one that the patterns know needs no more than that
        this kind is its likeliest label; any other needs a belief of BELIEF.
        """
        found = mentions(text, base)
        if all(m.label >= 0 for m in found):
            return []
        belief = self.labels(found)
        best, most = belief.argmax(axis=1).tolist(), belief.max(axis=1).tolist()
        known = {(key, m.label) for m in found if m.label >= 0 for key in m.keys}
        return [(LABELS[k], m.start, m.end) for m, k, b in zip(found, best, most, strict=True) if m.label < 0 and k < len(KINDS) and (b >= BELIEF or any((key, k) in known for key in m.keys))]


def observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to counted examples: a mention's features, its label, and the labels before, after and of the first similar mention (-1 for none)."""
    for batch in batches:
        events: Counter = Counter()
        for text in batch.column(0).to_pylist():
            found = mentions(text, base_spans(text))
            labels = [m.label if m.label >= 0 else len(KINDS) for m in found]
            known = {key for m in found if m.label >= 0 for key in m.keys}
            # A repeat that the patterns miss has no label to learn from.
            unsure = [m.label < 0 and not known.isdisjoint(m.keys) for m in found]
            first: dict[str, int] = {}
            for i, m in enumerate(found):
                if unsure[i]:
                    continue
                before = labels[i - 1] if i and not unsure[i - 1] else -1
                after = labels[i + 1] if i + 1 < len(found) and not unsure[i + 1] else -1
                similar = next((first[k] for k in m.keys if k in first), -1)
                for key in m.keys:
                    first.setdefault(key, labels[i])
                plain, own = m.features
                for some in (plain + own, plain, ()):
                    events[" ".join(some), labels[i], before, after, similar] += 1
        rows = list(events)
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)), pa.array([events[r] for r in rows], pa.int64())], names=["features", "label", "before", "after", "similar", "n"])


def fit_field(examples: list[tuple[str, int, int, int, int, int]], steps: int = FIT_STEPS, ridge: float = RIDGE) -> SkipChain:
    """Potentials that maximise the examples' pseudo-likelihood, less a ridge: each mention's label given its features and its neighbours' labels.

    Similar mentions agree or do not: one weight. It is fitted for a pair of
    mentions and turned into the potential of a mention and its hub that gives
    a pair the same odds once the hub is summed out.
    """
    size = len(LABELS)
    names = {f: i for i, f in enumerate(sorted({f for e in examples for f in e[0].split()}))}
    row = np.array([i for i, e in enumerate(examples) for _ in e[0].split()], dtype=np.int64)
    feature = np.array([names[f] for e in examples for f in e[0].split()], dtype=np.int64)
    label, before, after, similar, n = (np.array([e[k] for e in examples], dtype=np.int64) for k in range(1, 6))
    target = np.zeros((len(examples), size))
    target[np.arange(len(examples)), label] = 1
    n = n / 3
    sides = [(before, np.nonzero(before >= 0)[0]), (after, np.nonzero(after >= 0)[0])]
    tied = np.nonzero(similar >= 0)[0]
    prior, unary, table, agree = np.zeros(size), np.zeros((len(names), size)), np.zeros((size, size)), 0.0
    # That similar mentions agree is the field's assumption: its weight is hardly drawn to zero.
    pull = np.full(size + unary.size + table.size + 1, ridge)
    pull[-1] = ridge / 100
    moments: list = [0.0, 0.0]
    for step in range(1, steps + 1):
        score = np.tile(prior, (len(examples), 1))
        for y in range(size):
            score[:, y] += np.bincount(row, unary[feature, y], minlength=len(examples))
        score[sides[0][1]] += table[before[sides[0][1]]]
        score[sides[1][1]] += table.T[after[sides[1][1]]]
        score[tied, similar[tied]] += agree
        score -= score.max(axis=1, keepdims=True)
        chance = np.exp(score)
        chance /= chance.sum(axis=1, keepdims=True)
        off = (target - chance) * n[:, None]
        slope_table = np.zeros((size, size))
        np.add.at(slope_table, before[sides[0][1]], off[sides[0][1]])
        np.add.at(slope_table.T, after[sides[1][1]], off[sides[1][1]])
        slope_unary = np.stack([np.bincount(feature, off[row, y], minlength=len(names)) for y in range(size)], axis=1)
        every = np.concatenate([prior, unary.ravel(), table.ravel(), [agree]])
        slope = np.concatenate([off.sum(axis=0), slope_unary.ravel(), slope_table.ravel(), [off[tied, similar[tied]].sum()]]) - pull * every
        moments = [0.9 * moments[0] + 0.1 * slope, 0.99 * moments[1] + 0.01 * slope**2]
        every = every + 0.3 * min(1.0, 4 * (1 - step / (steps + 1))) * moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        prior, rest = every[:size], every[size:]
        unary, rest = rest[: unary.size].reshape(unary.shape), rest[unary.size :]
        table, agree = rest[:-1].reshape(size, size), float(rest[-1])
    odds = np.exp(max(agree, 0.0))
    hub = odds + np.sqrt(odds * odds + (size - 2) * odds - (size - 1))
    return SkipChain({f: unary[i] for f, i in names.items()}, prior, table, np.eye(size) * np.log(hub))


def fit_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS, max_examples: int = 20_000) -> SkipChain:
    """Potentials from the labels of the fixed patterns in about ``train_docs`` documents, chosen by a hash of the id.

    Equal examples are counted together; the driver sees at most ``max_examples`` of them, the most frequent.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    draw = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1_000_000))
    share = max(1, int(1_000_000 * min(1.0, train_docs / max(1, rows.count()))))
    keys = ["features", "label", "before", "after", "similar"]
    counted = rows.where(draw < share).select("text").mapInArrow(tidy(observed), "features string, label int, before int, after int, similar int, n long").groupBy(*keys).agg(F.sum("n").alias("n"))
    return fit_field([tuple(r) for r in materialise(counted.orderBy(F.desc("n"), *keys).limit(max_examples), "pii-examples").orderBy(*keys).collect()])


def scan(docs: DataFrame, model: SkipChain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    A null text counts as empty: no spans, and the digest of an empty string.
    Spans count code points and exclude their end. Repeated rows get equal
    results; an empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, every = [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                n = Counter(k for k, _, _ in base)
                counts.append([n[k] for k in KINDS])
                text_base = joined(base)
                digests.append(hashlib.sha256(text_base.encode()).hexdigest())
                added = model.spans(text, base)
                every.append(joined(base + added) if added else text_base)
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(every, pa.string())], names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return rows.mapInArrow(tidy(spans), f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def pii_scan(docs: DataFrame) -> DataFrame:
    """Learn the potentials from a sample of ``docs``, then scan all rows."""
    return scan(docs, fit_pii(docs))
