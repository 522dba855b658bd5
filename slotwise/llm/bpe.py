"""BPE encoding as a bounded-lookahead streaming transducer, decoding as an incremental state machine.

Encoding. The merge list decides, for two neighbouring tokens, whether they can stand side by
side: no merge that is due earlier joins the pieces that meet at their border. A sequence is the
merge procedure's result exactly if all its neighbours can. So every prefix of the input has one
last token, found by trying the tokens that end there, and the prefixes form a tree. A token
that covers a later symbol starts at most LOOKAHEAD symbols back (the longest token that the
merge list can make, less one), so later prefixes descend from the last LOOKAHEAD + 1 ones only;
the path that those have in common is stable, is emitted and is forgotten. Memory depends on the
merge list, not on the input.

Words that the splitter yields are separate inputs; the results of recent words are kept in a
memo of a bounded number of words of bounded length, which changes no result. Texts with added
tokens, or with code points that this Python's Unicode tables and the library's may see otherwise,
are normalized and split by the library.

Decoding. decode() feeds ids to a state machine that knows what came before: vocabularies
without a decoder give their tokens joined by spaces, byte-level ones give bytes, whose
incomplete ends stay in the state until the next id.

Defined results: null text is empty; an empty text has no ids and decodes to an empty text; null
doc_ids and repeated rows are each returned; other columns are ignored.
"""

from __future__ import annotations

import codecs
import json
import string
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import common as C

VOCABULARY = "word_bpe_49k.json"
#: Unicode's White_Space, as the splitter sees it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
#: Bytes of text of which a word is encoded once.
CHUNK = 4 << 20
SCHEMA = "doc_id long, ids array<int>"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(plain)))
    return [out[b] for b in range(256)]


class Recent(dict):
    """A memo of a word's ids that holds at most 2 `limit` words, of which none is longer than LONG bytes, so its size
    is bounded in bytes; the words of the last `limit` puts stay."""

    LONG = 64

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def of(self, words: list[str], encode_words) -> list[bytes]:
        """The ids of different words; encode_words is asked for those that aren't known."""
        out = list(map(self.get, words))
        missing = [i for i, x in enumerate(out) if x is None] if None in out else []
        if missing:
            if self.old:
                old, ask = self.old.get, []
                for i in missing:
                    word = words[i]
                    ids = old(word)
                    if ids is None:
                        ask.append(i)
                    else:
                        out[i] = self[word] = ids
            else:
                ask = missing
            for i, ids in zip(ask, encode_words([words[i] for i in ask]), strict=True):
                out[i], word = ids, words[i]
                if len(word) <= self.LONG and len(ids) <= 4 * self.LONG:
                    self[word] = ids
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
        return out


class Transducer:
    """The merge list as tables, and the encoding of one word."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.vocab, self.suffix = vocab, suffix
        self.rank = {}
        self.made: dict[int, int] = {}  # token -> rank of the merge that makes it
        self.parts: dict[int, tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            pair, token = (vocab[a], vocab[b]), vocab[a + b]
            self.rank.setdefault(pair, r)
            if token not in self.made:
                self.made[token], self.parts[token] = r, pair
        self.lookahead = max((len(x.removesuffix(suffix)) for x in vocab), default=1) - 1
        # every end of a token -> that token, or -1 where it is only an end
        self.tails: dict[str, int] = {}
        for x in vocab:
            for at in range(1, len(x.removesuffix(suffix)) if suffix else len(x)):
                self.tails.setdefault(x[at:], -1)
        self.tails.update(vocab)
        self.beside: dict[tuple[int, int], bool] = {}

    def can_stand(self, left: int, right: int) -> bool:
        """Whether no merge that is due earlier joins pieces across the border of the two tokens."""
        known = self.beside.get((left, right))
        if known is not None:
            return known
        never, ok = 1 << 60, True
        a, used_a = left, never  # a: the piece left of the border; used_a: the rank at which it becomes part of a larger one
        while ok:
            b, used_b = right, never
            while True:
                r = self.rank.get((a, b))
                if r is not None and r < used_a and r <= used_b:
                    ok = False
                    break
                if b not in self.parts:
                    break
                used_b, b = self.made[b], self.parts[b][0]
            if a not in self.parts:
                break
            used_a, a = self.made[a], self.parts[a][1]
        if len(self.beside) >= 200_000:
            self.beside.clear()
        self.beside[left, right] = ok
        return ok

    def stream(self, word: str) -> Iterator[int]:
        """The tokens of a word given as one character for each symbol; what a vocabulary marks word ends with belongs
        to the last. The word is taken in blocks; between them only the part that isn't stable is kept."""
        tails, beside = self.tails, self.beside
        block, size = 4 * (self.lookahead + 1), len(word)
        text, last, read = "", [(-1, -1)], 0  # the symbols kept; of each prefix its last token and where that begins
        while read < size:
            done = len(text)
            text += word[read : read + block]
            read += block
            for i in range(done + 1, len(text) + 1):
                tail = self.suffix if read >= size and i == len(text) else ""
                start, fits = i - 1, []
                while start >= 0:
                    token = tails.get(text[start:i] + tail if tail else text[start:i])
                    if token is None:
                        break
                    if token >= 0:
                        fits.append((token, start))
                    start -= 1
                while fits:
                    fit = fits.pop()
                    token, start = fit
                    before = last[start][0]
                    if before >= 0:
                        ok = beside.get((before, token))
                        if self.can_stand(before, token) if ok is None else ok:
                            last.append(fit)
                            break
                    elif not start:
                        last.append(fit)
                        break
                else:
                    last.append((-1, -1))  # no token ends here
            if read < size:
                cut, emitted = self._stable(last)
                if cut:
                    yield from emitted
                    text = text[cut:]
                    last = [(last[cut][0], -1)] + [(t, s - cut) for t, s in last[cut + 1 :]]
        out, at = [], len(text)
        while at > 0:
            token, start = last[at]
            if token < 0:
                raise ValueError("a symbol is not in the vocabulary")
            out.append(token)
            at = start
        yield from reversed(out)

    def _stable(self, last: list[tuple[int, int]]) -> tuple[int, list[int]]:
        """The furthest prefix that all prefixes within the lookahead descend from (0 if only the first), and the tokens up to it."""
        live = {i for i in range(len(last) - self.lookahead - 1, len(last)) if last[i][0] >= 0}
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(max(0, last[top][1]))
        cut = at = live.pop() if live else 0
        out = []
        while at > 0:
            out.append(last[at][0])
            at = last[at][1]
        return cut, out[::-1]


#: What is cut off a word's end at once; the splitter keeps a run of these as one word.
MARKS = string.punctuation
_BLANKS = regex.compile(rf"[{SPACE}--[\x00-\x7f]]", regex.V1)


def strange() -> np.ndarray:
    """Of each code point whether the library, whose Unicode tables are of another version, may see it otherwise: those
    that this Python's tables don't know or that are newer than the library's."""
    out = np.zeros(0x110000, bool)
    out[[i for i in range(0x110000) if unicodedata.category(chr(i)) in ("Cn", "Cs")]] = True
    out[NEWER[0] : NEWER[1]] = True
    return out


#: CJK Extension I, of Unicode 15.1.
NEWER = 0x2EBF0, 0x2EE5E


class Words:
    """Texts -> ids: normalized, split and made distinct with Arrow, so that a word costs once for each chunk of texts,
    and looked up in a memo of bounded size.

    Splitting at white space first changes nothing, as it is never part of a word.
    """

    WORDS = 500_000

    def __init__(self, added: dict[str, int], encode_words, whole, kind: str = "<u4"):
        """encode_words: a list of normalized words -> the bytes of their ids, numbers of this kind; whole: a text that
        can't be split like that (with an added token, or with strange code points) -> its ids."""
        self.encode_words, self.whole, self.added, self.kind = encode_words, whole, list(added), np.dtype(kind)
        self.words, self.strange = Recent(self.WORDS), None

    @staticmethod
    def normal(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")  # lower-cased by itself, wherever it stands
        return text.lower()

    def odd(self, texts: list[str]) -> set[int]:
        """The texts that can't be split here."""
        out = {i for i, x in enumerate(texts) if "<" in x and any(a in x for a in self.added)}
        beyond = [i for i, x in enumerate(texts) if not x.isascii()]
        if beyond:
            if self.strange is None:
                self.strange = strange()
            flat = np.frombuffer("".join([texts[i] for i in beyond]).encode("utf-32-le"), np.uint32)
            if len(at := np.flatnonzero(self.strange[flat])):
                ends = np.cumsum([len(texts[i]) for i in beyond])
                out.update(beyond[j] for j in np.searchsorted(ends, at, "right").tolist())
        return out

    def missing(self, pieces: list[str]) -> list[bytes]:
        """The ids of different normalized pieces that the memo doesn't have."""
        parts = {i: SPLIT.findall(x) for i, x in enumerate(pieces) if not x.isalpha()}
        more = {w for own in parts.values() if len(own) > 1 for w in own}
        ask = [x for i, x in enumerate(pieces) if len(parts.get(i, "-")) == 1]
        more = list(more.difference(ask))
        of = dict(zip(ask + more, self.encode_words(ask + more), strict=True))
        return [of[x] if (x in of) else b"".join([of[w] for w in parts[i]]) for i, x in enumerate(pieces)]

    def ids(self, texts: list[str]) -> pa.Array:
        """The ids of each text, as binary values."""
        odd, plain = self.odd(texts), []
        for i, text in enumerate(texts):
            if i in odd:
                plain.append("")
                continue
            text = self.normal(text)
            if not text.isascii():
                text = _BLANKS.sub(" ", text)
            plain.append(text)
        split = pa.compute.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        found = pa.compute.list_flatten(split).dictionary_encode()
        # letters and the marks behind them are two words: the same bytes, cut once more
        pieces, which = found.dictionary, found.indices.to_numpy()
        body = pa.compute.ascii_rtrim(pieces, characters=MARKS)
        size = pa.compute.binary_length(body).to_numpy()
        two = pa.compute.utf8_is_alpha(body).to_numpy(zero_copy_only=False) | (size == 0)
        offsets = np.frombuffer(pieces.buffers()[1], np.int64)[: len(pieces) + 1] if len(pieces) else np.zeros(1, np.int64)
        cuts = np.empty(2 * len(pieces) + 1, np.int64)
        cuts[::2], cuts[1::2] = offsets, np.where(two, offsets[:-1] + size, offsets[1:])
        words = pa.LargeStringArray.from_buffers(2 * len(pieces), pa.py_buffer(cuts), pieces.buffers()[2] or pa.py_buffer(b"")).dictionary_encode()
        ids = pa.array(self.words.of(words.dictionary.to_pylist(), self.missing), pa.large_binary())
        flat = ids.take(pa.array(words.indices.to_numpy().reshape(-1, 2)[which].ravel()))
        ends = np.frombuffer(flat.buffers()[1], np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        at = ends[2 * np.concatenate([[0], np.cumsum(pa.compute.list_value_length(split).to_numpy())])]
        out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(at)), flat.buffers()[2] or pa.py_buffer(b"")])
        if not odd:
            return out
        return pa.array([self.whole(texts[i]) if i in odd else x for i, x in enumerate(out.to_pylist())], pa.large_binary())


class Codec:
    """A byte-level BPE vocabulary with word ends and added tokens: text -> ids -> text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(x) if not isinstance(x, str) else tuple(x.split(" ")) for x in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.transducer = Transducer(model["vocab"], merges, self.suffix)
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = model["vocab"] | self.added
        self.names = [""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.names[i] = name
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.alphabet = byte_alphabet()
        self.byte_level = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.path, self.lib = path, None
        self.words = Words(self.added, lambda words: list(map(self.word, words)), self.mixed)

    def word(self, word: str) -> bytes:
        """The ids of a word of the splitter, as little-endian 32-bit numbers."""
        if not (symbols := word).isascii() or not word.isprintable():
            table = self.alphabet
            symbols = "".join([table[b] for b in word.encode()])
        return array("I", self.transducer.stream(symbols)).tobytes()

    def mixed(self, text: str) -> bytes:
        """The ids of a text with added tokens or strange code points, which the library normalizes and splits."""
        if self.lib is None:
            from tokenizers import Tokenizer

            self.lib = Tokenizer.from_file(self.path)
        out = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                for word, _ in self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(part)):
                    out += self.transducer.stream(word)
        return np.array(out, np.uint32).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, np.uint32) for x in self.words.ids(texts).to_pylist()]

    def decoder(self) -> "Decoder":
        return Decoder(self)


class Decoder:
    """Ids in, text out: feed() gives what is certain so far, end() the rest."""

    def __init__(self, codec: Codec):
        self.names, self.byte_level, self.begun = codec.names, codec.byte_level, False
        if self.byte_level:
            self.byte = {c: b for b, c in enumerate(codec.alphabet)}
            self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        names = self.names
        if self.byte_level:
            return self.state.decode(bytes(self.byte[c] for i in ids for c in names[i]))
        out = " ".join([names[i] for i in ids])
        if self.begun:
            return " " + out
        self.begun = True
        return out

    def end(self) -> str:
        return self.state.decode(b"", True) if self.byte_level else ""


def encoded(batches: Iterable[pa.RecordBatch], codec: Codec) -> Iterator[pa.RecordBatch]:
    """Batches of doc_id, text -> batches of doc_id, ids."""
    for part in C.chunks(batches, limit=CHUNK):
        ids = codec.words.ids([x or "" for x in part.column(1).to_pylist()])
        size = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1] // 4
        flat = pa.Array.from_buffers(pa.int32(), int(size[-1]), [None, ids.buffers()[2] or pa.py_buffer(b"")])
        yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(size.astype(np.int32), flat)], ["doc_id", "ids"])


#: Ids that the decoder is fed at once.
FEED = 65536


def decoded(batches: Iterable[pa.RecordBatch], codec: Codec) -> Iterator[pa.RecordBatch]:
    """Batches of doc_id, ids -> the same with the decoded text."""
    for batch in batches:
        out = []
        for ids in batch.column(1):
            ids, machine = ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int32), codec.decoder()
            out.append("".join([machine.feed(ids[s : s + FEED].tolist()) for s in range(0, len(ids), FEED)]) + machine.end())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["doc_id", "ids", "decoded"])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids of every row."""
    path = path or C.vocab_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encoded(batches, Codec(path))
        C.give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, decoded of every row of doc_id, ids."""
    path = path or C.vocab_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from decoded(batches, Codec(path))

    return tokens.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, SCHEMA + ", decoded string")


def round_trip(docs: DataFrame, finish, schema: str, path: str | None = None) -> DataFrame:
    """Encodes and decodes every row in one stage and hands the batches of doc_id, ids, decoded to finish."""
    path = path or C.vocab_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)  # a task's own, so that an idle worker keeps nothing
        yield from map(finish, decoded(encoded(batches, codec), codec))
        del codec
        C.give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
