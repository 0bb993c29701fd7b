"""Operator 2, byte-level BPE encoding and decoding over a trie of the distinct words.

A vocabulary file of the ``tokenizers`` library (byte-level BPE) is read once on the
driver and broadcast; its size is that of the vocabulary, whatever the corpus. Texts are
cut into words by the library's split rule. The distinct words of a chunk of texts that
are not yet known are put into a trie of bytes; a depth-first walk carries for every
node the last token of the encoding of the prefix that ends there:

    the last token of a prefix is the one token that ends it and that follows the
    encoding of what comes before (the last token there) without a merge across the seam.

So a prefix that many words share is encoded once, and the ids of a word are read back
from its node along the last tokens. Whether two tokens may stand side by side depends on
the merges at their seam alone.

A null text encodes as the empty text (no ids); null ids decode to the empty text. Texts of
any length are encoded whole: they are cut only where a word surely ends. Special
tokens found in a text get their own id, as in the library. Repeated rows are encoded each
for itself (their words once). Other columns are kept; a column named like the output raises.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from tripflow.llm.common import bound_batches, ship

#: Fixed value: the split rule of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CHUNK_CHARS = 1 << 20
KNOWN_WORDS = 600_000  # words a worker remembers, within the bytes of its encoder; beyond that it forgets all and starts again
_WORD_BYTES = 220  # held for a word besides its characters
_LONG_WORD = 512  # longer ones are not remembered
_KNOWN_SEAMS = 300_000
_NEVER = 1 << 60


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others follow from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in own}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(own))
    return [out[b] for b in range(256)]


#: Kinds of characters in the split rule.
SIGN, LETTER, NUMBER, SPACE, UNASSIGNED = range(5)
_KINDS: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """The kind of every code point. Unicode versions differ only on what this one leaves unassigned."""
    if not _KINDS:
        of = {"L": LETTER, "N": NUMBER}
        categories = list(map(unicodedata.category, map(chr, range(0x110000))))
        kind_of = {c: UNASSIGNED if c == "Cn" else of.get(c[0], SIGN) for c in set(categories)}
        table = np.array([kind_of[c] for c in categories], dtype=np.uint8)
        table[[c for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F]] = SPACE
        _KINDS.append(table)
    return _KINDS[0]


def word_starts(cp: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Whether a word of :data:`SPLIT` starts at each code point of a row of texts that begin at ``begins``.

    The rule in terms of neighbours: a run of one kind is a word, and one space before it
    belongs to it. The last character of a run of white space stands apart from the run if a
    text goes on after it. An apostrophe that starts a word takes the letters of a contraction.
    """
    n = len(cp)
    before, after = np.empty(n, dtype=np.uint8), np.full(n, 255, dtype=np.uint8)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    before[begins] = 255
    after[begins[begins > 0] - 1] = 255
    space = kind == SPACE
    spaced = np.zeros(n, dtype=bool)
    spaced[1:] = cp[:-1] == 0x20
    spaced[begins] = False
    start = (kind != before) & ~(spaced & ~space) | space & (after != SPACE) & (after != 255)
    marks = np.flatnonzero((cp == 0x27) & start & (after == LETTER))
    if len(marks):
        padded = np.concatenate((cp, np.zeros(3, dtype=cp.dtype)))
        one, two = padded[marks + 1], padded[marks + 2]
        # The second letter must be of the same text: then it is a letter after a letter.
        joined = np.concatenate((before, [255] * 3))[marks + 2] == LETTER
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = joined & ~short & ((two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | (one == ord("l")) & (two == ord("l")))
        start[marks[short | long] + 1] = False
        ends = np.concatenate((marks[short] + 2, marks[long] + 3))
        ends = ends[ends < n]
        start[ends[(kind[ends] == LETTER) & (before[ends] == LETTER)]] = True
    return start


_PLACES = 64
_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, _PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def distinct_words(cp: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one occurrence, number among the distinct) of the words that begin at ``starts``.

    Words are grouped by a 64-bit hash and then compared with their group's own word, character
    by character; if two words shared a hash, all are told apart the slow way.
    """
    size = np.diff(starts, append=len(cp))
    at = np.arange(len(cp))
    place = at - np.repeat(starts, size)
    if size.max(initial=0) <= _PLACES:
        factor = _FACTORS[place]
    else:
        factor = _FACTORS[place % _PLACES] * (place // _PLACES * 2 + 1).astype(np.uint64)
    h = np.add.reduceat((cp.astype(np.uint64) + np.uint64(1)) * factor, starts)
    h ^= h >> np.uint64(32)
    h = h * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64)
    order = np.argsort(h)
    h = h[order]
    begins = np.concatenate(([True], h[1:] != h[:-1]))
    first, number = order[begins], np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(begins) - 1
    of = first[number]
    if (size[of] == size).all() and (cp[at + np.repeat(starts[of] - starts, size)] == cp).all():
        return first, number
    seen: dict[bytes, int] = {}
    number = np.array([seen.setdefault(cp[x:x + n].tobytes(), len(seen)) for x, n in zip(starts, size)])
    return np.unique(number, return_index=True)[1], number


class Encoder:
    """Encodes and decodes texts by one vocabulary file, given as its content."""

    most_bytes = 48 << 20  # of remembered words

    def __init__(self, content: bytes):
        self.content = content
        spec = json.loads(content)
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if (model["type"], pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) != ("BPE", "ByteLevel", False, True) \
                or spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("the vocabulary is not plain byte-level BPE")
        self.byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(sorted(map(re.escape, self.specials), key=len, reverse=True)) + ")") if self.specials else None
        self._library = None
        self.known: dict[str, bytes] = {}  # word -> its ids as 32-bit integers
        self._held = 0  # bytes of them, about
        self._read(model)

    def _read(self, model: dict) -> None:
        """The tables of tokens and merges."""
        vocab = model["vocab"]
        size = 1 + max(chain(vocab.values(), self.specials.values()))
        self.token_bytes = [b""] * size
        for name, i in vocab.items():
            self.token_bytes[i] = bytes(self.byte_of[c] for c in name)
        # Parts and time of the merge that makes a token; single bytes have no parts.
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.made_at = [-1] * size
        self.merge_at: dict[tuple[int, int], int] = {}
        for when, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            made = vocab[a + b]
            if self.parts[made] is not None:
                raise ValueError("two merges make the same token")
            self.parts[made], self.made_at[made] = (vocab[a], vocab[b]), when
            self.merge_at[vocab[a], vocab[b]] = when
        self._seams: dict[int, bool] = {}
        # Left and right edge of a token: the tokens that stand there while it grows, and when each is absorbed.
        self._edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.token_of: dict[bytes, int] = {}
        whole = [False] * size
        for i in sorted(set(vocab.values()), key=lambda i: self.made_at[i]):
            p = self.parts[i]
            whole[i] = len(self.token_bytes[i]) == 1 if p is None else \
                whole[p[0]] and whole[p[1]] and self._first_merge_across(*p) == self.made_at[i]
            if whole[i]:  # a token whose own bytes encode to something else ends no prefix
                self.token_of[self.token_bytes[i]] = i
        self.longest = max(map(len, self.token_of))
        for text, i in self.specials.items():
            self.token_bytes[i] = text.encode()
        self.lengths = list(map(len, self.token_bytes))

    # -- seams ---------------------------------------------------------------
    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, time of absorption) along one edge, from the single byte up to the token itself."""
        out = self._edges.get((token, side))
        if out is None:
            up = [(token, _NEVER)]
            while (p := self.parts[up[-1][0]]) is not None:
                up.append((p[side], self.made_at[up[-1][0]]))
            out = self._edges[token, side] = up[::-1]
        return out

    def _first_merge_across(self, a: int, b: int) -> int | None:
        """When two neighbours first merge across their seam as their own merges go on; None for never.

        At equal times the pair further left merges first: one inside the left token goes
        before the seam, one inside the right token after it.
        """
        left, right = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        while True:
            (x, x_gone), (y, y_gone) = left[i], right[j]
            when = self.merge_at.get((x, y))
            if when is not None and when < x_gone and when <= y_gone:
                return when
            if x_gone == _NEVER and y_gone == _NEVER:
                return None
            if x_gone <= y_gone:
                i += 1
            else:
                j += 1

    def _fits(self, seam: int) -> bool:
        """Whether two tokens, packed into one number, may stand side by side."""
        if len(self._seams) > _KNOWN_SEAMS:
            self._seams.clear()
        ok = self._seams[seam] = self._first_merge_across(seam >> 32, seam & 0xFFFFFFFF) is None
        return ok

    # -- trie ----------------------------------------------------------------
    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, tuple[int, ...]]:
        """Ids of each distinct word, over one trie of all of them.

        Sorted, the words are the trie in depth-first order: a word's nodes are its prefixes, and
        those it shares with the word before it stand on the path already. ``last`` holds the last
        token at every node of the path, so each node of the trie is visited once.
        """
        token_of, seams, longest, lengths = self.token_of, self._seams, self.longest, self.lengths
        out: dict[bytes, tuple[int, ...]] = {}
        path, last = b"", [0]
        for word in sorted(words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and word[shared] == path[shared]:
                shared += 1
            del last[shared + 1:]
            for depth in range(shared + 1, len(word) + 1):
                # The token that ends here: exactly one qualifies, so the order of trial does not
                # matter; most are short.
                for start in range(depth - 1, max(-1, depth - longest - 1), -1):
                    token = token_of.get(word[start:depth])
                    if token is not None:
                        if start == 0:
                            break
                        seam = last[start] << 32 | token
                        fits = seams.get(seam)
                        if fits is None:
                            fits = self._fits(seam)
                        if fits:
                            break
                else:
                    raise ValueError("a byte is missing from the vocabulary")
                last.append(token)
            ids, depth = [], len(word)
            while depth:  # read the encoding back along the last tokens
                ids.append(last[depth])
                depth -= lengths[last[depth]]
            out[word] = tuple(ids[::-1])
            path = word
        return out

    # -- texts ---------------------------------------------------------------
    def _library_starts(self, piece: str) -> np.ndarray:
        """Word starts of a text with unassigned characters: the library's own splitter decides."""
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_str(self.content.decode()).pre_tokenizer
        words = [bytes(self.byte_of[c] for c in w).decode("utf-8", "surrogateescape") for w, _ in self._library.pre_tokenize_str(piece)]
        return np.cumsum([0, *map(len, words[:-1])])

    def _pieces(self, text: str) -> list[str]:
        """The text cut at special tokens (which stay as pieces)."""
        return self._special.split(text) if self._special is not None else [text]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of each of the distinct ``words`` as 32-bit integers; words not known yet are learnt."""
        known = self.known
        coded = list(map(known.get, words))
        new = [w for w, ids in zip(words, coded) if ids is None]
        if not new:
            return coded
        learnt = self.learn(new)
        if len(known) + len(new) > KNOWN_WORDS or self._held + self._price(new) > self.most_bytes:
            known.clear()
            self._held = 0
        fresh = iter(learnt)
        coded = [next(fresh) if ids is None else ids for ids in coded]
        if not known:  # forgotten, or at the start: all words of this chunk are the latest
            new, learnt = words, coded
        if max(map(len, new)) > _LONG_WORD:
            short = [(w, ids) for w, ids in zip(new, learnt) if len(w) <= _LONG_WORD]
            new = [w for w, _ in short]
            known.update(short)
        else:
            known.update(zip(new, learnt))
        self._held += self._price(new)
        return coded

    @staticmethod
    def _price(words: list[str]) -> int:
        return 4 * sum(map(len, words)) + _WORD_BYTES * len(words)

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of each of the distinct ``words`` as 32-bit integers, by the encoding itself."""
        as_bytes = [w.encode("utf-8", "surrogateescape") for w in words]
        ids = self.encode_words(as_bytes)
        return [array("i", ids[b]).tobytes() for b in as_bytes]

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids (int32) of each text, in order; texts are taken in chunks of about ``CHUNK_CHARS``."""
        parts: list[list[str | bytes]] = []  # per text: sections, or ids
        chars = 0
        for text in texts:
            parts.append([])
            for piece in self._pieces(text or ""):
                if piece in self.specials:
                    parts[-1].append(array("i", [self.specials[piece]]).tobytes())
                    continue
                for section in sections(piece):
                    parts[-1].append(section)
                    chars += len(section)
                    if chars >= CHUNK_CHARS:
                        self._look_up(parts)  # a long text's sections become ids as they come
                        chars = 0
            if not chars:
                yield from self._done(parts)
        self._look_up(parts)
        yield from self._done(parts)

    def _look_up(self, parts: list[list[str | bytes]]) -> None:
        """Turn the sections of all texts into ids, all at once."""
        held = [s for own in parts for s in own if isinstance(s, str)]
        if not held:
            return
        text = "".join(held)
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(s) for s in held])
        begins = ends - [len(s) for s in held]
        kind = kinds()[cp]
        start = word_starts(cp, kind, begins)
        unassigned = np.flatnonzero(kind == UNASSIGNED)
        for k in np.unique(np.searchsorted(ends, unassigned, side="right")):
            start[begins[k]:ends[k]] = False
            start[begins[k] + self._library_starts(held[k])] = True
        starts = np.flatnonzero(start)
        first, number = distinct_words(cp, starts)
        stops = np.append(starts[1:], len(cp))
        coded = self._ids_of([text[x:y] for x, y in zip(starts[first].tolist(), stops[first].tolist())])
        # Ids of the distinct words in a row, then of all words by their numbers.
        size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        flat, at = np.frombuffer(b"".join(coded), dtype=np.int32), np.cumsum(size) - size
        own = size[number]
        to = np.cumsum(own)
        ids = flat[np.repeat(at[number] - (to - own), own) + np.arange(to[-1])]
        cuts = np.concatenate(([0], to))[np.searchsorted(starts, np.concatenate((begins, [len(cp)])))]
        section = iter([ids[x:y].tobytes() for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())])
        for own_parts in parts:
            own_parts[:] = [b"".join(next(section) if isinstance(s, str) else s for s in own_parts)]

    @staticmethod
    def _done(parts: list[list[bytes]]) -> Iterator[np.ndarray]:
        for own in parts:
            yield np.frombuffer(b"".join(own), dtype=np.int32)
        parts.clear()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_SURE_END = re.compile(r"(?<=\S) (?=\S)")


def sections(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """``text`` in sections of about ``size`` characters, cut before a single space between two
    characters that are not white space: a word always starts there."""
    start = 0
    if not text:
        return
    while len(text) - start > size:
        m = _SURE_END.search(text, start + size)
        if m is None:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(content: bytes, kind: type[Encoder] = Encoder) -> Encoder:
    """The worker's encoder of a vocabulary; it lives on between tasks, and with it the known words."""
    key = kind, hashlib.sha256(content).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = kind(content)
    return _ENCODERS[key]


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:  # a file beside the library on the driver; executors get its content
        return f.read()


def _extended(df: DataFrame, out: str, kind, drop: str | None) -> StructType:
    if out in df.columns:
        raise ValueError(f"the input already has a column {out}")
    return StructType([*[f for f in df.schema if f.name != drop], StructField(out, kind)])


def encode(spark: SparkSession, df: DataFrame, vocabulary: str, text: str = "text", out: str = "ids", keep_text: bool = False) -> DataFrame:
    """``df`` with the ids of its texts (array of int); the text itself only if ``keep_text``."""
    return _coded(spark, df, vocabulary, text, out, keep_text, None, None)


def codec(spark: SparkSession, df: DataFrame, vocabulary: str, text: str = "text", out: str = "ids", decoded: str | None = "decoded",
          decodes: str | None = None) -> DataFrame:
    """``df`` with the ids of its texts in place of the texts, and with what the ids decode to: the text ``decoded``, or
    ``decodes``, whether it is the text that was encoded. One step encodes and decodes, so a worker holds one vocabulary."""
    return _coded(spark, df, vocabulary, text, out, False, decoded, decodes)


def _coded(spark: SparkSession, df: DataFrame, vocabulary: str, text: str, out: str, keep_text: bool, decoded: str | None, decodes: str | None) -> DataFrame:
    ship(spark)
    bound_batches(spark)
    schema = _extended(df, out, ArrayType(IntegerType()), None if keep_text else text)
    for name, kind in ((decoded, StringType()), (decodes, BooleanType())):
        if name is not None:
            if name in df.columns or name == out:
                raise ValueError(f"the input already has a column {name}")
            schema = StructType([*schema, StructField(name, kind)])
    content = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(content.value)
        for b in batches:
            kept = [c for i, c in enumerate(b.columns) if keep_text or i != at]
            done, held, more, size = 0, [], ([], []), 0
            for k, ids in enumerate(enc.encode(t.as_py() for t in b.column(at))):
                held.append(ids)
                size += len(ids)
                if decoded is not None or decodes is not None:
                    back = enc.decode(ids.tolist())
                    if decoded is not None:
                        more[0].append(back)
                    if decodes is not None:
                        more[1].append(back == (b.column(at)[k].as_py() or ""))
                if size >= CHUNK_CHARS:
                    yield _with_lists(kept, done, held, more, schema)
                    done, held, more, size = done + len(held), [], ([], []), 0
            if held:
                yield _with_lists(kept, done, held, more, schema)

    return df.mapInArrow(run, schema)


def _with_lists(columns: list[pa.Array], start: int, ids: list[np.ndarray], more: tuple[list, list], schema: StructType) -> pa.RecordBatch:
    offsets = np.zeros(len(ids) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    values = np.concatenate(ids)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
    extra = [pa.array(x, kind) for x, kind in zip(more, (pa.string(), pa.bool_())) if x]
    return pa.RecordBatch.from_arrays([*[c.slice(start, len(ids)) for c in columns], lists, *extra], names=schema.names)


def decode(spark: SparkSession, df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the texts of its ids."""
    ship(spark)
    schema = _extended(df, out, StringType(), None)
    content = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(content.value)
        for b in batches:
            lists = b.column(at)
            values = lists.values.to_numpy()
            ends = [o.as_py() for o in lists.offsets]
            # The slots of a null list may hold anything; its text is empty.
            texts = pa.array((enc.decode(values[x:y].tolist()) if ok else "" for x, y, ok in zip(ends, ends[1:], lists.is_valid().to_pylist())), type=pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=schema.names)

    return df.mapInArrow(run, schema)
