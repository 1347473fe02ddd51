"""BPE encoding by backtracking over longest matches, decoding by an offset table."""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from typing import NamedTuple

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from mergewell.llm.rows import with_computed

#: Fixed by the vocabulary file; letters and numbers are those of the library, see classes().
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|(?:[^\s{letters}{numbers}]|[\x1c-\x1f])+"
REMEMBERED = 250_000  # chunks and token pairs a task remembers before it drops the older ones


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters for themselves, the other bytes in order from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Classes(NamedTuple):
    """What the tokenizers library takes for letters and numbers, as ranges of a pattern, and the
    lower case it gives to letters where Python's differs: both have tables of their own."""

    letters: str
    numbers: str
    lower: dict[str, str]


POINTS_ASKED = 1 << 14  # code points the library is asked for at once; it keeps notes for each


def classes() -> Classes:
    """The library's classes, asked for every code point once, some thousands at a time."""
    kinds = {kind: pre_tokenizers.Split(Regex(rf"\p{{{kind}}}+"), "isolated") for kind in "LN"}
    members = {kind: [] for kind in kinds}  # (first, last) of the runs
    lower: dict[str, str] = {}
    for start in range(0, 0x110000, POINTS_ASKED):
        points = [chr(p) for p in range(start, start + POINTS_ASKED) if not 0xD800 <= p < 0xE000]
        if not points:
            continue
        asked = "\n" + "".join(points)  # others and members alternate; a line feed is no member
        for kind, cutter in kinds.items():
            for piece, _ in cutter.pre_tokenize_str(asked)[1::2]:
                for p in map(ord, piece):  # a run may step over the surrogates or go on in the next block
                    if members[kind] and members[kind][-1][1] == p - 1:
                        members[kind][-1][1] = p
                    else:
                        members[kind].append([p, p])
        lines = [c for c in points if c != "\n"]
        low = normalizers.Lowercase().normalize_str("\n".join(lines)).split("\n")
        lower.update({c: x for c, x in zip(lines, low) if x != c.lower()})
    return Classes(*["".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in members[kind]) for kind in "LN"], lower)


class WordBpe:
    """Encoder for a vocabulary whose words end in a suffix and whose ids follow merge order.

    Symbols are bytes and bytes that end a word.  A token sequence is the exact result of the
    merges if and only if every two neighbours are compatible: undoing both along their common
    border never meets a merge that would have come first.  So the encoder takes the longest
    match at each place, steps to shorter ones or back where neighbours don't fit, and visits
    no place twice.
    """

    def __init__(self, definition: bytes | str, classed: Classes | None = None):
        classed = classed or classes()
        spec = json.loads(definition)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        vocabulary = model["vocab"]
        letters = byte_letters()
        symbol = {letter: chr(b) for b, letter in enumerate(letters)}
        closing = {letter: chr(0x100 + b) for b, letter in enumerate(letters)}

        def spelled(token: str) -> str:
            if token.endswith(suffix) and len(token) > len(suffix):
                body = token[:-len(suffix)]
                return "".join(symbol[c] for c in body[:-1]) + closing[body[-1]]
            return "".join(symbol[c] for c in token)

        self.closers = [closing[c] for c in letters]
        self.automaton = ahocorasick.Automaton()
        self.tokens = {spelled(token): number for token, number in vocabulary.items()}
        self.sizes = {number: len(shape) for shape, number in self.tokens.items()}
        self.longest = max(self.sizes.values())
        for shape, number in self.tokens.items():
            self.automaton.add_word(shape, (len(shape), number))
        self.automaton.make_automaton()
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            whole = vocabulary[left + right]
            self.joined[vocabulary[left], vocabulary[right]] = whole
            self.halves[whole] = (vocabulary[left], vocabulary[right])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = re.compile(WORD_PATTERN.format(letters=classed.letters, numbers=classed.numbers))
        self.only_letters = re.compile(f"[{classed.letters}]+")
        self.lower = classed.lower
        self.odd = re.compile("[" + "".join(map(re.escape, classed.lower)) + "]") if classed.lower else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        texts = {number: token for token, number in {**vocabulary, **self.special}.items()}
        spaced = [(texts.get(i, "") + " ").encode() for i in range(max(texts) + 1)]
        self.offsets = np.concatenate(([0], np.cumsum([len(s) for s in spaced]))).astype(np.int64)
        self.letters = np.frombuffer(b"".join(spaced), np.uint8)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave these two neighbours apart."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 2 * REMEMBERED:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # `bound`: merges from this number on come after the border was already passed.
        bound = 1 << 62
        while True:
            whole = self.joined.get((left, right))
            if whole is not None and whole < bound:
                return False
            # Undo the later of both tokens; a token that is a single symbol cannot be undone.
            if left > right and left in self.halves:
                bound, left = left, self.halves[left][1]
            elif right in self.halves:
                bound, right = right + 1, self.halves[right][0]
            elif left in self.halves:
                bound, left = left, self.halves[left][1]
            else:
                return True

    def word(self, word: bytes) -> list[int]:
        """Tokens of one word."""
        size = len(word)
        shape = word[:-1].decode("latin-1") + self.closers[word[-1]]
        # Mostly the longest matches from left to right already fit together.
        path, covered, last, pairs = [], 0, None, self.pairs
        for end, (length, token) in self.automaton.iter_long(shape):
            if end - length + 1 != covered:
                break
            if last is not None:
                fits = pairs.get((last, token))
                if not (self.compatible(last, token) if fits is None else fits):
                    break
            path.append(token)
            covered, last = end + 1, token
        return path if covered == size else self.searched(shape, path)

    def searched(self, shape: str, path: list[int]) -> list[int]:
        """Tokens of one word that begins with the compatible tokens of path; shorter
        matches and steps back included."""
        size, tokens, pairs = len(shape), self.tokens, self.pairs
        path = list(path)
        place = sum(self.sizes[token] for token in path)
        dead = bytearray(size + 1)  # places from which nothing fits
        length = size - place
        while place < size:
            length = min(length, self.longest)
            last = path[-1] if path else None
            while length:
                token = tokens.get(shape[place:place + length])
                if token is not None and not dead[place + length]:
                    if last is None:
                        break
                    fits = pairs.get((last, token))
                    if self.compatible(last, token) if fits is None else fits:
                        break
                length -= 1
            if length:
                path.append(token)
                place += length
                length = size - place
            elif path:
                dead[place] = 1
                length = self.sizes[path.pop()]
                place -= length
                length -= 1
            else:
                raise ValueError("the vocabulary does not cover all bytes")
        return path

    def chunk(self, chunk: str) -> bytes:
        """Ids, four bytes each, of a normalised text between white space."""
        if len(self.known) > REMEMBERED:  # what was asked for since the last turn stays
            self.known, self.older = {}, self.known
        known = self.known
        packed = self.older.get(chunk)
        if packed is not None:
            known[chunk] = packed
            return packed
        if self.only_letters.fullmatch(chunk):
            ids = self.word(chunk.encode())
            known[chunk] = packed = struct.pack(f"<{len(ids)}I", *ids)
            return packed
        parts = []
        for word in self.words.findall(chunk):
            packed = known.get(word) or self.older.get(word)
            if packed is None:
                ids = self.word(word.encode())
                known[word] = packed = struct.pack(f"<{len(ids)}I", *ids)
            parts.append(packed)
        known[chunk] = packed = b"".join(parts)
        return packed

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of a text as little-endian unsigned 32-bit numbers."""
        if not text:
            return np.zeros(0, "<u4")
        parts: list[bytes] = []
        pieces = self.cut.split(text) if "<|" in text else (text,)
        for piece in pieces:
            if piece in self.special:
                parts.append(np.array([self.special[piece]], "<u4").tobytes())
                continue
            piece = self.lowered(unicodedata.normalize("NFC", piece))
            # str.split() also separates at U+001C to U+001F, which are no white space here.
            chunks = piece.split() if not CONTROLS.search(piece) else self.words.findall(piece)
            found = list(map(self.known.get, chunks))
            if None in found:
                found = [self.chunk(c) if ids is None else ids for c, ids in zip(chunks, found)]
            parts += found
        return np.frombuffer(b"".join(parts), "<u4")

    def lowered(self, text: str) -> str:
        """Lower case letter by letter: a final sigma is an ordinary sigma."""
        if self.odd and self.odd.search(text):
            return "".join([self.lower.get(c) or ("σ" if c == "Σ" else c.lower()) for c in text])
        return (text.replace("Σ", "σ") if "Σ" in text else text).lower()

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens' texts with one blank between them."""
        if not len(ids):
            return b""
        begin = self.offsets[ids]
        lengths = self.offsets[ids.astype(np.int64) + 1] - begin
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat(begin - (ends - lengths), lengths)
        return self.letters[places[:-1]].tobytes()


CONTROLS = re.compile("[\x1c-\x1f]")


_READY: dict[bytes, WordBpe] = {}  # one encoder per worker process


def encoder(definition: bytes, classed: Classes) -> WordBpe:
    key = hashlib.sha256(definition).digest()
    if key not in _READY:
        _READY.clear()
        _READY[key] = WordBpe(definition, classed)
    return _READY[key]


def encode_decode(df: DataFrame, vocabulary: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """df with n_tokens, ids_sha256, decoded_sha256 and, with_ids, the ids of each whole text.

    vocabulary: the tokenizer's file, read once on the driver and broadcast (a few MB whatever
    the data).  A missing or empty text has no tokens and decodes to an empty text.  Rows are
    independent: repeated rows get equal values, an empty table stays empty, and a column
    that is named like a result is replaced.  Very long texts are encoded whole, one at a time.
    """
    with open(vocabulary, "rb") as file:
        definition = df.sparkSession.sparkContext.broadcast((file.read(), classes()))
    fields = [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def make():
        bpe = encoder(*definition.value)

        def compute(value):
            ids = bpe.encode(value)
            out = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                   hashlib.sha256(bpe.decode(ids)).hexdigest())
            return (*out, ids.astype(np.int64)) if with_ids else out
        return compute

    return with_computed(df, [text], fields, make)
