"""Secret scans: fixed patterns, and formats learned by grammar inference.

The fixed patterns find labelled credentials. From all of them a prefix tree is
counted for each label, and states whose futures agree (how many signs are
left, which sign is next, and so on below) are merged into a probabilistic
automaton. Every credential-like token of the corpus is then scored by its
likelihood under each automaton against that of an ordinary word; tokens far
likelier as a credential are added.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.session import materialise, ship, tidy

#: Kinds in the order that breaks ties between spans with one start.
KINDS = ("assign", "access", "hex", "format")
KEY_WORDS = ("pass", "secret", "token", "api")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
#: What credentials are labelled with; each label has an automaton of its own.
LABELS = {"password": "password", "passwd": "password", "secret": "secret", "token": "token", "apikey": "api_key", "api_key": "api_key"}
#: A branch of less than one in FINE of a label's credentials has no states of its own, but shares those of its depth with branches whose
#: longest credential is about as long; what lies beyond LONGEST signs shares one state. So a tree has a bound, and counts every credential.
FINE, LONGEST = 300, 512
#: Signs of all the credentials of a label, to LONGEST of each, up to which the driver counts its tree (if all signs are at most 50 times so
#: many); beyond, Spark counts it level by level. The tree is the same.
TOGETHER = 20_000
#: Confidence of the Hoeffding bounds; nats a token, and nats a character, by which a credential must be likelier than a word.
ALPHA, MIN_GAIN, MIN_RATE = 0.05, 20.0, 1.0
#: A sign that follows a state far oftener than its class would have it is a symbol of its own: at least so many times, and deviations.
LITERAL_COUNT, LITERAL_SIGMAS = 5, 5.0
#: Symbol classes: hexadecimal lower-case letters, other lower case, capitals, digits, punctuation. Signs stand for themselves.
SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
CLASSES = {c: "[hex]" if c in "abcdef" else "[lower]" if c.islower() else "[upper]" if c.isupper() else "[digit]" if c.isdigit() else "[mark]" for c in SIGNS}
SIZES = Counter(CLASSES.values())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind as listed, then start."""
    found = []
    low = text.lower()
    if any(k in low for k in KEY_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind as listed."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


@dataclass
class Automaton:
    """Probabilistic automaton: for each state the log-probability of its end, of an unseen sign with the next state, and of each symbol with the next state."""

    ends: list[float]
    other: list[tuple[float, int]]
    steps: list[dict[str, tuple[float, int]]]

    def score(self, token: str) -> float:
        """Log-likelihood of a token of SIGNS. A class shares its probability out evenly, as an unseen sign does over all signs."""
        state, total = 0, 0.0
        for c in token:
            steps = self.steps[state]
            if (step := steps.get(c)) is not None:
                total += step[0]
            elif (step := steps.get(CLASSES[c])) is not None:
                total += step[0] - math.log(SIZES[CLASSES[c]])
            else:
                step = self.other[state]
                total += step[0] - math.log(len(SIGNS))
            state = step[1]
        return total + self.ends[state]


@dataclass
class State:
    """A state of the tree or automaton: how often it was reached and was the end, what followed, how many signs were left, by how many words it was reached, and how often it was changed."""

    count: int = 0
    end: int = 0
    to: dict[str, int] = field(default_factory=dict)
    moved: Counter = field(default_factory=Counter)
    left: Counter = field(default_factory=Counter)
    words: int = 0
    changes: int = 0


def symbols(signs: Counter) -> dict[str, str]:
    """The symbol of each sign that follows a state: the sign itself where it stands out of its class, else the class."""
    classes: Counter = Counter()
    for c, n in signs.items():
        classes[CLASSES[c]] += n
    out = {}
    for c, n in signs.items():
        expected = classes[CLASSES[c]] / SIZES[CLASSES[c]]
        out[c] = CLASSES[c] if n < LITERAL_COUNT or n < expected + LITERAL_SIGMAS * math.sqrt(expected) else c
    return out


def chain(size: int) -> int:
    """Number, below 0, of the chain of states for small branches whose longest word has ``size`` signs: exact up to 64, by eighths of a power of two above."""
    step = 1 if size <= 64 else 1 << (size.bit_length() - 4)
    return -(-(-size // step) * step)


#: Steps of a tree's states, by symbol, to a state or a chain; None where the words that follow are not counted yet.
Steps = list[dict[str, int] | None]


def tally(steps: Steps, words: Iterable[str], last: bool) -> dict[tuple[int, int, int, str], list[int]]:
    """What words add to a tree: (state, depth, size, sign) with their number and the largest size, at states not counted yet or, if ``last``, along the chains.

    A size is a word's length, or one above LONGEST. Rows of size 0 count the next
    signs, rows of an empty sign the words that come to a state or into a chain.
    """
    counts: dict[tuple[int, int, int, str], list[int]] = {}
    for word in words:
        at = depth = 0
        while at >= 0 and (step := steps[at]) is not None and depth < len(word):
            at = step[word[depth]] if word[depth] in step else step[CLASSES[word[depth]]]
            depth += 1
        size = min(len(word), LONGEST + 1)
        if at >= 0:
            keys = [(at, depth, size, "")] if steps[at] is None else []
            if keys and depth < len(word):
                keys.append((at, depth, 0, word[depth]))
        else:
            keys = [(at, depth, size, ""), *((at, min(i, LONGEST), 0, word[i]) for i in range(depth, len(word)))] if last else []
        for key in keys:
            row = counts.setdefault(key, [0, 0])
            row[0] += 1
            row[1] = max(row[1], size)
    return counts


class Tree:
    """A prefix tree of ``total`` words that grows by a level at a time from counts of all of them. Edges are classes, or signs where one stands out of its class."""

    def __init__(self, total: int):
        self.total, self.states, self.depths = total, [State()], [0]
        self.steps: Steps = [None]
        self.open = [0]

    def grow(self, counts: dict[tuple[int, int, int, str], list[int]]) -> None:
        """Count the open states and open those that follow; small branches, and what lies deeper than LONGEST, go to chains."""
        signs: dict[int, Counter] = defaultdict(Counter)
        most: dict[tuple[int, str], int] = {}
        for (at, depth, size, sign), (n, longest) in counts.items():
            if sign:
                signs[at][sign], most[at, sign] = n, longest
            else:
                self.states[at].count += n
                self.states[at].words += n
                self.states[at].left[size - depth] += n
        opened, self.open = self.open, []
        for at in opened:
            state, step, longest = self.states[at], {}, Counter()
            state.end = state.left[0]
            for c, symbol in symbols(signs[at]).items():
                state.moved[symbol] += signs[at][c]
                longest[symbol] = max(longest[symbol], most[at, c])
            for symbol, n in sorted(state.moved.items()):
                if n * FINE < self.total or self.depths[at] + 1 == LONGEST:
                    step[symbol] = chain(longest[symbol])
                else:
                    step[symbol] = len(self.states)
                    self.open.append(len(self.states))
                    self.states.append(State())
                    self.depths.append(self.depths[at] + 1)
                    self.steps.append(None)
            self.steps[at] = step

    def close(self, counts: dict[tuple[int, int, int, str], list[int]]) -> list[State]:
        """The states with those of the chains, which are one for each depth; the last of a long chain leads to itself."""
        entered: dict[int, dict[int, Counter]] = defaultdict(lambda: defaultdict(Counter))
        signs: dict[tuple[int, int], Counter] = defaultdict(Counter)
        for (at, depth, size, sign), (n, _) in counts.items():
            if sign:
                signs[at, depth][sign] = n
            else:
                entered[at][depth][size] = n
        states, place = list(self.states), {}
        for link in sorted(entered, reverse=True):
            held: Counter = Counter()
            for depth in range(min(entered[link]), LONGEST + 1):
                held.update(entered[link].get(depth, {}))
                if not held:
                    continue
                moved: Counter = Counter()
                for c, symbol in symbols(signs[link, depth]).items():
                    moved[symbol] += signs[link, depth][c]
                left = Counter({size - depth: n for size, n in held.items()}) if depth < LONGEST else Counter({0: held.total(), 1: moved.total()})
                place[link, depth] = len(states)
                states.append(State(left.total(), left[0], {}, moved, left, held.total()))
                held.pop(depth, None)
        for (link, depth), i in place.items():
            states[i].to = {s: place[link, min(depth + 1, LONGEST)] for s in states[i].moved}
        for state, step, depth in zip(self.states, self.steps, self.depths, strict=True):
            state.to = {s: t if t >= 0 else place[t, depth + 1] for s, t in step.items()}
        return states


def prefix_tree(words: list[str]) -> list[State]:
    """States of the words' prefixes; the first is the empty prefix."""
    tree = Tree(len(words))
    while tree.open:
        tree.grow(tally(tree.steps, words, False))
    return tree.close(tally(tree.steps, words, True))


def counted_trees(words: DataFrame, totals: dict[str, int]) -> dict[str, list[State]]:
    """The prefix trees of each kind's tokens (columns ``kind``, ``token``), counted by Spark: one job for each level that has branches above 1 in FINE, and one for all chains."""
    trees = {kind: Tree(n) for kind, n in totals.items()}

    def count(last: bool) -> dict[str, dict[tuple[int, int, int, str], list[int]]]:
        steps = {kind: tree.steps for kind, tree in trees.items() if last or tree.open}

        def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = defaultdict(list)
                for kind, token in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    own[kind].append(token)
                rows = [(kind, *key, *row) for kind, some in own.items() for key, row in tally(steps[kind], some, last).items()]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

        schema = pa.schema([("kind", pa.string()), ("state", pa.int64()), ("depth", pa.int64()), ("size", pa.int64()), ("sign", pa.string()), ("n", pa.int64()), ("longest", pa.int64())])
        key = ["kind", "state", "depth", "size", "sign"]
        some = words.where(F.col("kind").isin(list(steps))).select("kind", "token").mapInArrow(tidy(tallied), "kind string, state long, depth long, size long, sign string, n long, longest long")
        out: dict[str, dict] = {kind: {} for kind in steps}
        for r in some.groupBy(*key).agg(F.sum("n").alias("n"), F.max("longest").alias("longest")).collect():
            out[r["kind"]][r["state"], r["depth"], r["size"], r["sign"]] = [r["n"], r["longest"]]
        return out

    while any(tree.open for tree in trees.values()):
        for kind, counts in count(False).items():
            trees[kind].grow(counts)
    return {kind: trees[kind].close(counts) for kind, counts in count(True).items()} if trees else {}


def apart(a: State, b: State, width: float) -> bool:
    """Whether two states' own counts differ by more than Hoeffding's bound: of signs left, of the end, of any next symbol."""
    bound = width * (1 / math.sqrt(a.words) + 1 / math.sqrt(b.words))
    if abs(a.end / a.count - b.end / b.count) > bound or any(abs(a.moved[s] / a.count - b.moved[s] / b.count) > bound for s in a.moved.keys() | b.moved.keys()):
        return True
    return distance(a, b) > bound


def distance(a: State, b: State) -> float:
    """Largest difference of the two cumulated shares of signs left."""
    total, most = 0.0, 0.0
    for k in sorted(a.left.keys() | b.left.keys()):
        total += a.left[k] / a.count - b.left[k] / b.count
        most = max(most, abs(total))
    return most


def root(into: list[int] | range, i: int) -> int:
    """The state that state i was merged into."""
    while into[i] != i:
        into[i] = i = into[into[i]]
    return i


def agree(states: list[State], x: int, y: int, width: float, into: list[int] | range | None = None, failed: dict | None = None) -> bool:
    """Whether two states, and all states that one continuation reaches from both, are not apart.

    ``failed`` keeps pairs that do not agree, with the two states that are apart
    and their numbers of changes: until one of these changes, it tells them apart.
    """
    into = range(len(states)) if into is None else into
    failed = {} if failed is None else failed
    todo: list = [((x, y), None)]
    seen: dict = {}
    while todo:
        (p, q), before = todo.pop()
        pair = root(into, p), root(into, q)
        if pair[0] == pair[1] or pair in seen:
            continue
        seen[pair] = before
        a, b = states[pair[0]], states[pair[1]]
        why = failed.get(pair)
        if why is None or (why[0].changes, why[1].changes) != why[2:]:
            why = (a, b, a.changes, b.changes) if apart(a, b, width) else None
        if why:
            while pair is not None:
                failed[pair] = why
                pair = seen[pair]
            return False
        todo += [((a.to[s], b.to[s]), pair) for s in a.to.keys() & b.to.keys()]
    return True


def fold(states: list[State], x: int, y: int, into: list[int], red: list[int]) -> set[int]:
    """Merge state y, and what follows it, into state x and what follows that; returns the states that others were merged into. A red state, the earliest one, stays."""
    order = {r: i for i, r in enumerate(red)}
    todo, changed = [(x, y)], set()
    while todo:
        p, q = sorted((root(into, i) for i in todo.pop()), key=lambda i: order.get(i, len(order)))
        if p == q:
            continue
        a, b = states[p], states[q]
        into[q] = p
        changed.add(p)
        a.count += b.count
        a.words += b.words
        a.changes += 1
        b.changes += 1
        a.end += b.end
        a.moved.update(b.moved)
        a.left.update(b.left)
        for s, t in b.to.items():
            if s in a.to:
                todo.append((a.to[s], t))
            else:
                a.to[s] = t
    return {root(into, p) for p in changed}


def infer(words: list[str], alpha: float = ALPHA) -> Automaton | None:
    """The automaton of words; None without any."""
    return merged(prefix_tree(words), alpha) if words else None


def merged(states: list[State], alpha: float = ALPHA) -> Automaton:
    """Merge compatible states of a prefix tree, red-blue fashion, in order of depth.

    A blue state goes to the compatible red state whose lengths left are nearest
    (the earliest of equals). So branches too sparse for any test to refuse
    join the states of their own depth, and a format keeps its length law.
    """
    width = math.sqrt(0.5 * math.log(2 / alpha))
    into = list(range(len(states)))
    red, known, failed = [0], {0}, {}
    queue = deque((0, s) for s in sorted(states[0].to))
    while queue:
        parent, s = queue.popleft()
        blue = root(into, states[root(into, parent)].to[s])
        if blue in known:
            continue
        ranked = sorted((distance(states[r], states[blue]), i) for i, r in enumerate(red))
        match = next((red[i] for _, i in ranked if agree(states, red[i], blue, width, into, failed)), None)
        if match is None:
            red.append(blue)
            known.add(blue)
            changed = {blue}
        else:
            changed = fold(states, match, blue, into, red)
            red = [r for r in red if into[r] == r]
            known = set(red)
        queue.extend((r, c) for r in red if r in changed for c in sorted(states[r].to) if root(into, states[r].to[c]) not in known)
    number = {r: i for i, r in enumerate(red)}
    ends, other, steps = [], [], []
    for r in red:
        state = states[r]
        # One more count for the end and one for a sign not seen here, so that no format is closed.
        n = state.count + 2
        ends.append(math.log((state.end + 1) / n))
        usual = max(state.moved.items(), key=lambda x: (x[1], x[0]), default=None)
        other.append((math.log(1 / n), number[root(into, state.to[usual[0]])] if usual else number[r]))
        steps.append({s: (math.log(c / n), number[root(into, state.to[s])]) for s, c in state.moved.items()})
    return Automaton(ends, other, steps)


@dataclass
class SecretModel:
    """One automaton for each label that had examples, and log-probabilities of sign pairs in ordinary words ("^" and "$" are their borders)."""

    formats: dict[str, Automaton]
    word: dict[str, float]

    def gain(self, token: str) -> float:
        """Nats by which the best format beats the word model; -inf without formats."""
        best = max((a.score(token) for a in self.formats.values()), default=-math.inf)
        return best - sum(self.word[a + b] for a, b in zip("^" + token, token + "$", strict=True))

    def spans(self, text: str, base: list[tuple[str, int, int]], known: dict[str, float]) -> tuple[list[tuple[str, int, int]], float | None]:
        """Tokens scored as credentials outside the base spans, and the largest gain of any candidate; ``known`` caches gains."""
        out, best = [], None
        for m in CANDIDATE.finditer(text):
            token = m[0]
            gain = known.get(token)
            if gain is None:
                gain = known[token] = self.gain(token)
            best = gain if best is None else max(best, gain)
            if gain >= MIN_GAIN and gain >= MIN_RATE * len(token) and not any(a < m.end() and m.start() < b for _, a, b in base):
                out.append(("format", *m.span()))
        return out, best


#: Number of each byte of a Latin-1 text: its place in SIGNS and one more, 0 for what no credential holds.
BYTE_SIGN = np.array([SIGNS.find(chr(i)) + 1 for i in range(256)])
KINDS_OF_SIGN = len(SIGNS) + 1


def sign_pairs(text: str) -> np.ndarray:
    """Counts of neighbouring signs, a square table; the first place stands for any border of a token."""
    code = BYTE_SIGN[np.frombuffer(f" {text} ".encode("latin-1", "replace"), dtype=np.uint8)]
    return np.bincount(code[:-1] * KINDS_OF_SIGN + code[1:], minlength=KINDS_OF_SIGN**2)


def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to labelled tokens: credentials of the fixed patterns, and sign pairs of all other words with counts."""
    before, after = "^" + SIGNS, "$" + SIGNS
    for batch in batches:
        kinds: list[str] = []
        tokens: list[str] = []
        pairs = np.zeros(KINDS_OF_SIGN**2, dtype=np.int64)
        for text in batch.column(0).to_pylist():
            base = base_spans(text)
            rest, at = [], 0
            for kind, a, b in sorted(base, key=lambda s: s[1]):
                m = ASSIGN.match(text, a) if kind == "assign" else None
                kinds.append(LABELS[m[1].lower()] if m else kind)
                tokens.append(m[2] if m else text[a:b])
                rest.append(text[at : max(at, a)])
                at = max(at, b)
            pairs += sign_pairs(" ".join([*rest, text[at:]]))
        seen = np.nonzero(pairs)[0].tolist()
        named = [before[i // KINDS_OF_SIGN] + after[i % KINDS_OF_SIGN] for i in seen]
        yield pa.RecordBatch.from_arrays([pa.array(kinds + ["word"] * len(seen), pa.string()), pa.array(tokens + named, pa.string()), pa.array([1] * len(kinds) + pairs[seen].tolist(), pa.int64())], names=["kind", "token", "n"])


def fit_secrets(docs: DataFrame, text_col: str = "text", together: int = TOGETHER) -> SecretModel:
    """Learn formats from the credentials of all documents, each different one once, and the word model from all their other words.

    The driver sees one count for each pair of signs, and of each label either
    few credentials (see TOGETHER), or counts whose number has a bound (see
    FINE), however many documents there are.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    found = materialise(rows.mapInArrow(tidy(labelled), "kind string, token string, n long").groupBy("kind", "token").agg(F.sum("n").alias("n")), "labelled")
    counts = {r["token"]: r["n"] for r in found.where("kind = 'word'").orderBy("token").collect()}
    tokens = found.where("kind <> 'word'")
    sizes = {r["kind"]: r for r in tokens.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("token")).alias("signs"), F.sum(F.least(F.length("token"), F.lit(LONGEST))).alias("upper")).collect()}
    large = {kind: r["n"] for kind, r in sizes.items() if r["upper"] > together or r["signs"] > 50 * together}
    words: dict[str, list[str]] = defaultdict(list)
    for r in tokens.where(~F.col("kind").isin(list(large))).collect() if len(large) < len(sizes) else []:
        words[r["kind"]].append(r["token"])
    trees = {kind: prefix_tree(own) for kind, own in words.items()} | counted_trees(tokens, large)
    return SecretModel({label: merged(trees[label]) for label in dict.fromkeys([*LABELS.values(), *KINDS[1:3]]) if label in trees}, word_model(counts))


def word_model(counts: dict[str, int]) -> dict[str, float]:
    """Log-probability of each sign after each sign, one count more for each pair; "^" begins and "$" ends a word."""
    total: Counter = Counter()
    for pair, n in counts.items():
        total[pair[0]] += n
    return {a + b: math.log((counts.get(a + b, 0) + 1) / (total[a] + KINDS_OF_SIGN)) for a in "^" + SIGNS for b in SIGNS + "$"}


def scan(docs: DataFrame, model: SecretModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, best_gain.

    best_gain: the nats by which the likeliest credential among the text's
    tokens of 16 signs or more beats an ordinary word; null without such a token.

    A null text counts as empty: no spans, and the digest of an empty string.
    Spans count code points and exclude their end. Repeated rows get equal
    results; an empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, float] = {}
            counts, digests, every, gains = [], [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                n = Counter(k for k, _, _ in base)
                counts.append([n[k] for k in KINDS[:3]])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                added, best = model.spans(text, base, known)
                every.append(joined(base + added))
                gains.append(best)
                if len(known) > 200_000:
                    known.clear()
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(every, pa.string()), pa.array(gains, pa.float64())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "best_gain"])

    return rows.mapInArrow(tidy(spans), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, best_gain double")


def secret_scan(docs: DataFrame) -> DataFrame:
    """Learn the formats from all of ``docs``, then scan all rows."""
    return scan(docs, fit_secrets(docs))


def redact(docs: DataFrame, model: SecretModel, mark: str = "[SECRET]", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``, overlapping spans as one, and the length column, if there is one, renewed. Null texts stay."""
    ship(docs.sparkSession)
    names = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, float] = {}
            texts = batch.column(names.index(text_col)).to_pylist()
            changed = set()
            for i, text in enumerate(texts):
                if text is None:
                    continue
                base = base_spans(text)
                parts, at = [], 0
                for _, a, b in sorted(base + model.spans(text, base, known)[0], key=lambda s: s[1:]):
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                if parts:
                    texts[i] = "".join([*parts, text[at:]])
                    changed.add(i)
            columns = list(batch.columns)
            columns[names.index(text_col)] = pa.array(texts, pa.string())
            if length_col in names:
                sizes = batch.column(names.index(length_col))
                columns[names.index(length_col)] = pa.array([len(texts[i]) if i in changed else x for i, x in enumerate(sizes.to_pylist())], sizes.type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(tidy(clean), docs.schema)
