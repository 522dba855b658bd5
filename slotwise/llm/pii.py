"""Personal data: fixed patterns, and a skip-chain conditional random field that adds to them.

base_spans() finds e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers by
pattern. The field then labels tokens (runs of anything but white space) as one of these kinds or
none. Tokens without a digit, `@` or `+` are fixed as none, so each document's field consists of
the other ones: neighbours share a transition potential, and each occurrence of a token is tied to
the next one in the document that is the same, or that has the same seven or more digits, by a skip
potential, however far away. Loopy message passing, damped, gives each token's marginals; graphs
have at most RUN tokens, of several documents or of a piece of one. A document of more is taken in
pieces by two sweeps: the first gathers what its pieces believe of tokens that are likely entities,
the second passes that on to the same tokens in other pieces. Tokens whose best label has at least
CERTAIN probability and that follow each other become a span, if it meets no base span: personal
data that the patterns lose, as a phone number or a card that more digits follow, or a number that
the document has in a clearer form elsewhere.

The weights are learned piece by piece on the driver from a bounded sample: of the different texts
with such tokens and of at most SAMPLE_BYTES bytes the SAMPLE_DOCS with the least hashes, and of
these as many as have SAMPLE_TOKENS tokens; the patterns' spans are its labels. The potentials of tokens are a softmax regression on their shape and
their neighbours', learned with these shown and hidden; those of pairs are log-odds of counts.

Defined results: null text is empty and has no spans; null doc_ids and repeated rows are each
returned; without any sample the field adds nothing; other columns are ignored or passed on.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import common as C

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_BYTES, CERTAIN, ROUNDS, DAMPING, STILL = 2000, 8_000, 0.9, 15, 0.5, 0.01
#: Tokens of the sample at most (texts after that are left out of it), and of one graph.
SAMPLE_TOKENS, RUN = 100_000, 50_000
Span = tuple[int, int, int]  # start, end, kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
# a number's later digits can't begin an address where its first can't
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_MARK = re.compile(r"[0-9@+]\S*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, in order of start and kind."""
    out = [(s, e, 0) for s, e in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(y := x.lstrip("0")) <= 3 and int(y or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if 12 <= len(digits := _NOT_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


# ---------------------------------------------------------------- tokens and features

_EDGES = ".,;:!?\"'()[]<>|*$%&#"


def tokens(text: str) -> Iterator[tuple[int, int]]:
    """The tokens that may be personal data."""
    for m in _MARK.finditer(text):
        start = m.start()
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        yield start, m.end()


_DIGITS, _LENGTHS = (1, 3, 5, 8, 12, 16, 20), (4, 8, 13, 20, 40)


def _bins(x: int, cuts: tuple[int, ...]) -> list[float]:
    out = [0.0] * (len(cuts) + 1)
    out[sum(x >= c for c in cuts)] = 1.0
    return out


def shape(token: str) -> list[float]:
    """What a token looks like, whatever its letters and digits are."""
    digits = sum(c.isdigit() for c in token)
    core = token.strip(_EDGES)
    local, at, domain = core.partition("@")
    dots = core.count(".")
    flags = (at != "", at != "" and "." in domain.strip("."), local != "" and at != "", dots == 3, dots > 0, token.startswith("+"), token.startswith("("), "-" in core, any(c.isalpha() for c in core), any(c in "=:/_" for c in core), digits == len(core) > 0)
    return [float(x) for x in flags] + _bins(digits, _DIGITS) + _bins(len(core), _LENGTHS)


def valid(token: str) -> tuple[float, float]:
    """Whether the token's own digits are a card's, and whether it is an address."""
    core = token.strip(_EDGES)
    digits = _NOT_DIGITS.sub("", core) if len(core) <= 40 else ""
    return float(12 <= len(digits) <= 19 and luhn(digits)), float(bool(m := _IP.fullmatch(core)) and all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")))


WIDTH = len(shape(""))
#: A token's shape, its left and right neighbours', the two validities and a constant.
FEATURES = 3 * WIDTH + 3
_PLAIN = str.maketrans({**{c: "0" for c in "123456789"}, **{c: "a" for c in "bcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"}})


class Shapes:
    """Numbers for shapes: equal ones have one number, so there are few."""

    LIMIT = 50_000

    def __init__(self):
        self.rows, self.number, self.seen = [[0.0] * WIDTH], {(0.0,) * WIDTH: 0}, {}

    def of(self, token: str) -> tuple[int, bool, bool]:
        """The number of a token's shape (0 is no token's), whether it may be valid() and whether it may tell who it is of."""
        key = token.translate(_PLAIN) if len(token) <= 64 else None
        if key in self.seen:
            return self.seen[key]
        own = tuple(shape(token))
        number = self.number.setdefault(own, len(self.rows))
        if number == len(self.rows):
            self.rows.append(list(own))
        digits = sum(c.isdigit() for c in token)
        out = number, digits >= 12 or token.count(".") >= 3, digits >= 3 or "@" in token
        if key is not None:
            if len(self.seen) >= self.LIMIT:
                self.seen.clear()
            self.seen[key] = out
        return out


class Graph:
    """The tokens of some documents: shapes, neighbours and skip edges. Memory is some numbers for each token.

    parts: of some of the texts their number and their tokens; all tokens of all texts, if not given.
    """

    def __init__(self, texts: list[str], parts: list[tuple[int, list[tuple[int, int]]]] | None = None, shapes: Shapes | None = None):
        if parts is None:
            parts = [(d, list(tokens(x))) for d, x in enumerate(texts)]
        self.shapes = shapes or Shapes()
        n = sum(len(found) for _, found in parts)
        doc, self.at, self.keys, numbers, joined = [], [], [], [], []
        self.valid, skips, i = np.zeros((n, 2), np.float32), [], 0
        for d, found in parts:
            text, end = texts[d], None
            seen: dict[str, int] = {}
            for s, e in found:
                word = text[s:e]
                number, perhaps, telling = self.shapes.of(word)
                numbers.append(number)
                if perhaps:
                    self.valid[i] = valid(word)
                joined.append(end is not None and (s == end + 1 or not text[end:s].strip()))
                end, keys = e, ()
                if telling:
                    digits = _NOT_DIGITS.sub("", word)
                    keys = {word.strip(_EDGES).lower(), digits if len(digits) >= 7 else ""} - {""}
                    for key in keys:
                        if key in seen and (seen[key], i) not in skips[-1:]:
                            skips.append((seen[key], i))
                        seen[key] = i
                self.keys.append(keys)
                i += 1
            doc += [d] * len(found)
            self.at += found
        self.doc, self.shape, self.joined = np.array(doc, np.int64), np.array(numbers, np.int64), np.array(joined, bool)
        right = np.flatnonzero(self.joined)
        self.edges = np.stack([right - 1, right], 1)
        self.skips = np.array(skips, np.int64).reshape(-1, 2)

    @cached_property
    def features(self) -> np.ndarray:
        """All features of all tokens, for learning and for small graphs; where they are made, the field goes by them."""
        own, (left, right) = np.array(self.shapes.rows, np.float32), self.neighbours()
        return np.concatenate([own[self.shape], own[left], own[right], self.valid, np.ones((len(self.at), 1), np.float32)], 1)

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """The shapes' numbers of each token's left and right neighbours, 0 for none."""
        left = np.where(self.joined, np.concatenate([[0], self.shape[:-1]]), 0)
        right = np.where(np.append(self.joined[1:], False), np.append(self.shape[1:], 0), 0)
        return left, right


def gold(graph: Graph, spans: list[list[Span]]) -> np.ndarray:
    """0 or 1 + kind for each token: the span that covers most of it."""
    out = np.zeros(len(graph.at), np.int64)
    for i, (d, (s, e)) in enumerate(zip(graph.doc.tolist(), graph.at, strict=True)):
        most = 0
        for a, b, kind in spans[d]:
            if (shared := min(e, b) - max(s, a)) > most and 2 * shared > e - s:
                most, out[i] = shared, kind + 1
    return out


# ---------------------------------------------------------------- the field


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _add(to: np.ndarray, at: np.ndarray, what: np.ndarray) -> None:
    for label in range(to.shape[1]):
        to[:, label] += np.bincount(at, what[:, label], len(to))


def _through(x: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """What beliefs at one end of edges say at the other, as logarithms of probabilities."""
    out = np.log(np.exp(x - x.max(1, keepdims=True)) @ np.exp(tie) + 1e-300)
    return out - _lse(out, 1)[:, None]


def beliefs(unary: np.ndarray, groups: list[tuple[np.ndarray, np.ndarray]], rounds: int, doc: np.ndarray | None = None) -> np.ndarray:
    """Of each token the probabilities of the labels, by damped loopy message passing in logarithms, given its own scores
    and groups of edges (i, j) with the potentials of their labels; exact where the edges are a forest and rounds enough.
    doc: each token's document; no edge joins two. A document's messages end when they are still, whatever others do."""
    doc = np.zeros(len(unary), np.int64) if doc is None else doc
    live = np.ones(int(doc.max(initial=-1)) + 1, bool)
    groups = [(x[:, 0], x[:, 1], tie) for x, tie in groups if len(x)]
    said = [[np.zeros((len(a), unary.shape[1])), np.zeros((len(a), unary.shape[1]))] for a, _, _ in groups]

    def total() -> np.ndarray:
        out = unary.astype(np.float64)
        for (a, b, _), (there, back) in zip(groups, said, strict=True):
            _add(out, b, there)
            _add(out, a, back)
        return out

    for _ in range(rounds if groups else 0):
        belief, moved = total(), np.zeros(len(live))
        for (a, b, tie), own in zip(groups, said, strict=True):
            on = np.flatnonzero(live[doc[a]])
            there, back = own[0][on], own[1][on]
            new = _through(belief[a[on]] - back, tie), _through(belief[b[on]] - there, tie.T)
            for i, old in enumerate((there, back)):
                step = (1 - DAMPING) * (new[i] - old)
                np.maximum.at(moved, doc[a[on]], np.abs(step).max(1, initial=0))
                own[i][on] = old + step
        live &= moved >= STILL
        if not live.any():
            break
    belief = total()
    return np.exp(belief - _lse(belief, 1)[:, None])


class Field:
    """Weights: softmax of tokens, a matrix for neighbours and one for skip edges."""

    LABELS = len(KINDS) + 1

    def __init__(self, texts: list[str]):
        taken, size = [], 0
        for d, text in enumerate(texts):
            if (size := size + len(own := list(tokens(text)))) > SAMPLE_TOKENS:
                break
            taken.append((d, own))
        graph = Graph(texts, taken)
        y = gold(graph, [base_spans(x) for x in texts])
        n, k = len(y), self.LABELS
        self.weights, self.next, self.skip = np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros((k, k))
        self.learned = n > 0
        if not n:
            return
        # each token as it stands, and those that are no part of a longer span with their neighbours hidden as well, so that
        # their own shape and the skip edges tell more
        whole = graph.features
        several = np.zeros(n, bool)
        same = (y[graph.edges[:, 0]] == y[graph.edges[:, 1]]) & (y[graph.edges[:, 0]] > 0)
        several[graph.edges[same].ravel()] = True
        bare = whole[~several]
        bare[:, WIDTH : 3 * WIDTH] = 0
        rows, which = np.unique(np.concatenate([whole, bare]).astype(np.float64), axis=0, return_inverse=True)
        target = np.zeros((len(rows), k))
        np.add.at(target, (which, np.concatenate([y, y[~several]])), 1 / len(which))
        mass, square = target.sum(1, keepdims=True), np.full_like(self.weights, 1e-8)
        for _ in range(400):  # AdaGrad on the regularised likelihood
            z = rows @ self.weights
            slope = rows.T @ (np.exp(z - _lse(z, 1)[:, None]) * mass - target) + 1e-4 * self.weights
            square += slope**2
            self.weights -= 0.5 * slope / np.sqrt(square)
        share = (np.bincount(y, minlength=k) + 1.0) / (n + k)
        for pairs, into in ((graph.edges, self.next), (graph.skips, self.skip)):
            count = np.full((k, k), 1.0)
            np.add.at(count, (y[pairs[:, 0]], y[pairs[:, 1]]), 1)
            if into is self.skip:
                count = count + count.T
            into += np.clip(np.log(count / count.sum()) - np.log(share[:, None] * share[None, :]), -3, 3) if len(pairs) else 0

    def marginals(self, graph: Graph, carried: dict[str, tuple[int, np.ndarray]] | None = None, piece: int = 0) -> np.ndarray:
        """Of each token the probabilities of the labels; carried: by key what other pieces of the document believe."""
        w = self.weights
        if "features" in graph.__dict__:
            unary = graph.features @ w
        else:
            own, (left, right) = np.array(graph.shapes.rows), graph.neighbours()
            unary = (own @ w[:WIDTH])[graph.shape] + (own @ w[WIDTH : 2 * WIDTH])[left] + (own @ w[2 * WIDTH : 3 * WIDTH])[right] + graph.valid @ w[-3:-1] + w[-1]
        unary = unary - _lse(unary, 1)[:, None]
        for i, keys in enumerate(graph.keys) if carried else ():
            for key in keys:
                if key in carried and carried[key][0] != piece:
                    unary[i] += _through(np.log(carried[key][1])[None, :], self.skip)[0]
        return beliefs(unary, [(graph.edges, self.next), (graph.skips, self.skip)], ROUNDS, graph.doc)

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """The field's own spans for each text, none of which meets a base span."""
        out: list[list[Span]] = [[] for _ in texts]
        if not self.learned:
            return out
        shapes, held, size = Shapes(), [], 0

        def settle() -> None:
            if held:
                graph = Graph(texts, held, shapes)
                self._spans(graph, self.marginals(graph), texts, base, out)
                held.clear()

        for d, text in enumerate(texts):
            stream = tokens(text)
            found = list(islice(stream, RUN + 1))
            if len(found) > RUN:
                self._long(d, shapes, texts, base, out)
                continue
            if size + len(found) > RUN:
                settle()
                size = 0
            if found:
                held.append((d, found))
                size += len(found)
        settle()
        return out

    def _long(self, d: int, shapes: Shapes, texts: list[str], base: list[list[Span]], out: list[list[Span]]) -> None:
        """A document of more than RUN tokens, in pieces: one sweep learns what they believe of entities, another uses it."""
        carried: dict[str, tuple[int, np.ndarray]] = {}
        for sweep in (0, 1):
            stream = tokens(texts[d])
            piece = 0
            while found := list(islice(stream, RUN)):
                graph = Graph(texts, [(d, found)], shapes)
                p = self.marginals(graph, carried if sweep else None, piece)
                if sweep:
                    self._spans(graph, p, texts, base, out)
                for i in np.flatnonzero(p[:, 0] < 0.5).tolist() if not sweep else ():
                    for key in graph.keys[i]:
                        if key not in carried or carried[key][1][0] > p[i, 0]:
                            carried[key] = (piece, np.maximum(p[i], 1e-6))
                piece += 1
            if not carried and not sweep:  # then no token is likely an entity
                return

    def _spans(self, graph: Graph, p: np.ndarray, texts: list[str], base: list[list[Span]], out: list[list[Span]]) -> None:
        label = np.where(p.max(1) >= CERTAIN, p.argmax(1), 0)
        lead = label > 0
        lead[1:] &= ~graph.joined[1:] | (label[1:] != label[:-1])
        for i in np.flatnonzero(lead).tolist():
            j = i + 1
            while j < len(label) and label[j] == label[i] and graph.joined[j]:
                j += 1
            d = int(graph.doc[i])
            start, end = graph.at[i][0], graph.at[j - 1][1]
            while start < end and texts[d][start] in ".,;:!?\"'([<|*$%&#":
                start += 1
            while start < end and texts[d][end - 1] in ".,;:!?\"')]>|*$%&#":
                end -= 1
            at = bisect_left(base[d], (end,))  # base spans that begin before the end
            if start < end and not any(e > start for _, e, _ in base[d][max(0, at - 8) : at]):
                out[d].append((start, end, int(label[i]) - 1))


def learn(docs: DataFrame) -> Field:
    """The field from a bounded sample of documents (doc_id, text)."""
    marked = docs.select("text").where((F.col("text").contains("@") | F.col("text").rlike("[0-9]{2}")) & (F.octet_length("text") <= SAMPLE_BYTES))
    rows = marked.withColumn("h", F.xxhash64("text"))
    n = rows.agg(F.approx_count_distinct("h")).first()[0]
    # about twice as many different texts as are wanted, each once, and of these the least hashes
    share = F.pmod("h", F.lit(1 << 20)) < int((1 << 20) * min(1.0, 2 * SAMPLE_DOCS / max(1, n)) + 1)
    some = rows.where(share).groupBy("h").agg(F.min("text").alias("text")).orderBy(F.pmod("h", F.lit(1 << 20)), "h").limit(SAMPLE_DOCS)
    return Field([r["text"] for r in some.select("text").collect()])


def _found(texts: list[str], field: Field) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(x) for x in texts]
    return base, [sorted(a + b, key=lambda x: (x[0], x[2], x[1])) for a, b in zip(base, field.added(texts, base), strict=True)]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
SCHEMA = "doc_id long, base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>"


def _told(spans: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in own] for own in spans], _SPANS)


def find(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, base and spans (base and the field's; code points, end exclusive) of every row."""
    shared = C.Shipped(docs.sparkSession, field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.chunks(batches):
            base, spans = _found([x or "" for x in part.column(1).to_pylist()], shared.get())
            yield pa.RecordBatch.from_arrays([part.column(0), _told(base), _told(spans)], ["doc_id", "base", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def masked_text(text: str, spans: list[Span]) -> str:
    """The text with [EMAIL], [IP], [CARD] or [PHONE] for each span; spans that overlap are one, of the first's kind."""
    out, at = [], 0
    for s, e, k in spans:
        if s < at:
            if e > at:
                at = e
            continue
        out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = e
    return "".join(out) + text[at:]


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """docs, all columns, with the spans of text masked."""
    shared = C.Shipped(docs.sparkSession, field)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.chunks(batches):
            raw = part.column(at).to_pylist()
            _, spans = _found([x or "" for x in raw], shared.get())
            new = pa.array([x if x is None else masked_text(x, own) for x, own in zip(raw, spans, strict=True)], pa.string())
            yield part.set_column(at, part.schema.field(at), new)

    return docs.mapInArrow(run, docs.schema)
