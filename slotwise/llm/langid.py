"""Language ID by cross-parsing entropy.

Each language has a suffix automaton of its labelled text. A text is cross-parsed against it: from
the left, the longest match that occurs in the labelled text is one phrase, and the next phrase
begins where it ended. c phrases against N labelled characters estimate the cross entropy as
c * log2(N) / n for n characters; the language with the least (the fewest normalised phrases) wins.
A walk through the automaton from its root is a match as long as there is a transition, so a
phrase ends where there is none.

Text is lower-cased; runs of anything but letters are one blank, since punctuation and digits say
nothing of the language. The parse is vectorised and exact: a text is cut into blocks of BLOCK
characters, which are parsed side by side for all languages, one table lookup per character and
language, as if a phrase began with each. Then each block's last phrase is parsed on into the next
block until a phrase begins where that block's own parse has one begin, too; from there on they are
the same, and the text's phrases are counted along the parts that are.

Learning takes a bounded sample: for each language the SAMPLE_DOCS documents with the least hash of
doc_id, those of at most DOC_CHARS characters first, of whose texts as many are learned as come to
TRAIN_CHARS characters; the last one is cut there. Each language has its own alphabet: an automaton
has at most 2 * TRAIN_CHARS states and 3 * TRAIN_CHARS transitions, and its table one column for
each of its LETTERS most frequent letters; the transitions of its other letters, as of scripts with
thousands, are a sorted list. All languages with text are learned, in models of at most LANGUAGES
languages each, so a model is bounded by the parameters; a task holds one of them at a time.

Defined results: `und` with score 0 if text is null or has no letter, or if no language was
learned; null langs aren't learned; ties go to the language first in alphabetical order; null
doc_ids are held out never and learned never; repeated rows are each returned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm import common as C

SAMPLE_DOCS, DOC_CHARS, TRAIN_CHARS, LANGUAGES = 200, 4000, 40_000, 16
BLOCK, LETTERS = 512, 62
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
SCHEMA = "doc_id long, lang_pred string, score double"


def letters(text: str) -> str:
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


def automaton(text: str) -> tuple[list[dict[str, int]], list[int]]:
    """The transitions of the suffix automaton of a text, and its states' lengths."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for c in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step, length


class Model:
    """Some languages' automata in one table: a state is where its row begins, and step[state + letter] is the next state,
    0 where a phrase ends, from where no letter leads on; a letter that has no column is looked up in `rare`."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        self.letter = {c: i for i, c in enumerate(sorted(set("".join(samples.values()))))}
        # each language's column of each letter; the last column stands for letters without one and has no transitions
        self.column = np.zeros((len(self.langs), len(self.letter) + 1), np.int32)
        tables, self.roots, self.bits, base = [np.zeros(LETTERS + 1, np.int32)], [], [], LETTERS + 1
        keys, values = [], []
        for j, lang in enumerate(self.langs):
            text = samples[lang]
            common = sorted(set(text), key=lambda c, n=Counter(text): (-n[c], c))[:LETTERS]
            own, width = {c: i for i, c in enumerate(common)}, len(common) + 1
            self.column[j] = width - 1
            for c, i in own.items():
                self.column[j, self.letter[c]] = i
            step, _ = automaton(text)
            table = np.zeros((len(step), width), np.int32)
            for s, moves in enumerate(step):
                for c, to in moves.items():
                    if c in own:
                        table[s, own[c]] = base + to * width
                    else:
                        keys.append((base + s * width << 21) + self.letter[c])
                        values.append(base + to * width)
            tables.append(table.ravel())
            self.roots.append(base)
            self.bits.append(float(np.log2(max(2, len(text)))))
            base += table.size
        self.step = np.concatenate(tables)
        order = np.argsort(np.array(keys, np.int64))
        self.rare = np.array(keys, np.int64)[order], np.array(values, np.int32)[order]
        self.codes = np.full(0x110000, len(self.letter), np.int32)
        for c, i in self.letter.items():
            self.codes[ord(c)] = i

    def next(self, state: np.ndarray, c: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The states after these by the letters given, whose columns are given, too."""
        now = self.step.take(state + column)
        keys, values = self.rare
        if len(keys):
            at = np.nonzero((now == 0) & (state > 0) & (c < len(self.letter)))
            own = (state[at].astype(np.int64) << 21) + np.broadcast_to(c, now.shape)[at]
            found = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            now[at] = np.where(keys[found] == own, values[found], 0)
        return now

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Texts x languages: the number of phrases of each text."""
        size = np.array([len(x) for x in texts], np.int64)
        flat = self.codes[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
        blocks = -(-size // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(size) - size, blocks) + nth * BLOCK
        length = np.minimum(BLOCK, size[owner] - nth * BLOCK)
        roots = np.array(self.roots, np.int32)[:, None]
        # begins: where a phrase begins in the blocks' own parses; last: the state that each ends in
        begins, last = np.zeros((len(roots), len(flat)), bool), np.zeros((len(roots), len(start)), np.int32)
        order = np.argsort(-length, kind="stable")
        first, sizes = start[order], length[order]
        state = np.zeros((len(roots), len(start)), np.int32)  # no phrase has begun, so one begins with the first letter
        live = np.searchsorted(-sizes, -np.arange(BLOCK), "left")  # blocks longer than each offset
        for t in range(int(sizes[0]) if len(sizes) else 0):
            m = live[t]
            c = flat[first[:m] + t]
            column = self.column.take(c, axis=1)
            now = self.next(state[:, :m], c, column)
            ended = now == 0
            if ended.any():
                # the phrase ended before this letter, which begins the next one (a letter never seen is a phrase)
                now = np.where(ended, self.next(np.broadcast_to(roots, now.shape), c, column), now)
                begins[:, first[:m] + t] = ended
            state[:, :m] = now
        last[:, order] = state
        out = np.zeros((len(texts), len(roots)), np.int64)
        if len(start):
            for j in range(len(roots)):
                out[:, j] = self._along(j, flat, begins[j], last[j], owner, start, start + length, blocks)
        return out

    def _along(self, j: int, flat: np.ndarray, begins: np.ndarray, last: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """For one language each text's number of phrases, from those of its blocks' own parses."""
        close = np.zeros(len(blocks), np.int64)
        close[owner] = end  # where each text ends
        more, meets = np.zeros(len(start), np.int64), end.copy()  # phrases that begin after a block in its last one's wake; where its wake ends
        live, state = np.flatnonzero(end < close[owner]), last[end < close[owner]]
        root = np.full(len(state), self.roots[j], np.int32)
        while len(live):
            at = meets[live]
            c = flat[at]
            column = self.column[j].take(c)
            now = self.next(state, c, column)
            ended = now == 0
            met = ended & begins[at]
            if ended.any():
                now = np.where(ended, self.next(root[: len(now)], c, column), now)
                more[live[ended & ~met]] += 1
            meets[live[~met]] += 1
            on = ~met & (meets[live] < close[owner[live]])
            live, state = live[on], now[on]
        count = np.concatenate([[0], np.cumsum(begins)])
        out, lead = np.zeros(len(blocks), np.int64), np.cumsum(blocks) - blocks
        text = np.flatnonzero(blocks)
        at = start[lead[text]]
        while len(text):  # a block's own phrases from where it was met, and those in its wake
            block = lead[text] + (at - start[lead[text]]) // BLOCK
            out[text] += count[end[block]] - count[at] + more[block]
            at = meets[block]
            on = at < close[text]
            text, at = text[on], at[on]
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Texts x languages: the normalised phrases."""
        return self.phrases(texts) * np.array(self.bits)


def predict(models: Iterable[Model], texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The language of each text, of those of all models, and its score."""
    plain = [letters(x) if x else "" for x in texts]
    some = [i for i, x in enumerate(plain) if x and any(map(str.isalpha, x))]
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if some:
        names, parts = [], []
        for model in models:
            names += model.langs
            parts.append(model.entropies([plain[i] for i in some]))
        if names:
            order = np.argsort(np.array(names, object), kind="stable")
            names, entropy = [names[i] for i in order], np.concatenate(parts, axis=1)[:, order]
            best = entropy.argmin(1)
            least = entropy[np.arange(len(some)), best]
            entropy[np.arange(len(some)), best] = np.inf
            second = entropy.min(1)
            for j, i in enumerate(some):
                langs[i] = names[best[j]]
                scores[i] = 1.0 if np.isinf(second[j]) else float(1 - least[j] / second[j])
    return langs, scores


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def learn(docs: DataFrame) -> list[Model]:
    """The automata of the languages of labelled documents that aren't held out."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))  # others teach nothing and take no place
    # of each language about four times the documents wanted, by a bound on the hash, and of those the least
    bounds = C.written(rows.groupBy("lang").agg(F.least(F.lit(1 << 40), F.expr(f"{SAMPLE_DOCS << 42}L div count(*) + 1")).alias("bound")), "bounds")  # its size decides how it is joined
    keyed = rows.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))).join(bounds, "lang").where("h < bound")
    keyed = keyed.select("lang", "doc_id", "h", (F.length("text") > DOC_CHARS).alias("long"), F.substring("text", 1, 2 * TRAIN_CHARS).alias("text"))
    some = keyed.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("long", "h", "doc_id", "text"))).where(F.col("n") <= SAMPLE_DOCS)
    samples: dict[str, str] = {}
    for lang, text in some.orderBy("lang", "n").select("lang", "text").toLocalIterator():
        own = samples.get(lang, "")
        if len(own) < TRAIN_CHARS and (plain := letters(text)):
            samples[lang] = (own + " " + plain)[:TRAIN_CHARS] if own else plain[:TRAIN_CHARS]
    langs = sorted(samples)
    return [Model({x: samples[x] for x in langs[i : i + LANGUAGES]}) for i in range(0, len(langs), LANGUAGES)]


def identify(docs: DataFrame, models: list[Model]) -> DataFrame:
    """doc_id, lang_pred, score of every row; only the text is looked at."""
    shared = [C.Shipped(docs.sparkSession, x) for x in models]

    def loaded() -> Iterator[Model]:
        for x in shared:
            yield x.get()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.chunks(batches, limit=(2 if len(shared) < 2 else 8) << 20):
            langs, scores = predict(loaded(), part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
