"""Byte pair encoding and decoding of whole texts with a given vocabulary.

Distinct words of a slice of texts are the paths of a trie. A depth-first walk carries, for every prefix on the
path, the last token of the prefix's encoding: as a prefix ends in exactly one token that is stable behind the
encoding of what precedes it, the encoding of any prefix is that token behind an encoding already known. So a
prefix shared by many words is encoded once, and a word is read off backwards from its last token.

A token pair is stable when no merge crosses its border; this is found by replaying the merges along the border
and is remembered per pair. Nothing is shuffled. A task holds one slice of texts and bounded tables, whatever the
size of the input; a single long text or long word costs time in proportion to its length.

Defined results: a null text is encoded as an empty one: no tokens, empty decoded text. All columns stay, columns
named ``token_ids``, ``n_tokens`` or ``decoded`` are replaced. Rows are independent, so repeated rows give
repeated results and an empty table gives an empty one.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from fathomline.llm.registry import query, table
from fathomline.llm.texts import slices
from fathomline.session import spread

MAX_WORDS = 250_000  # words whose encodings a worker remembers; then it starts anew
_NEVER = 1 << 60
# The white space of the vocabulary's pattern. str.split() also parts words at \x1c to \x1f.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE, _NOT_SPACE = re.compile(f"[{_BLANK}]+"), re.compile(r"[\x1c-\x1f]")


def _byte_symbols() -> list[str]:
    """The printable symbol that stands for each byte, as byte-level vocabularies write it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(extra)
            extra += 1
    return [symbols[b] for b in range(256)]


@lru_cache(maxsize=4)
def _class_of(kind: str) -> str:
    """Ranges of the characters whose general category begins with ``kind``, for use in a character class.

    They come from Python's Unicode tables. The vocabulary library's are newer: what Python does not know is left to
    the library (see ``Vocabulary.newer``).
    """
    ranges: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)).startswith(kind):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class Vocabulary:
    """Merges and tokens of a vocabulary file with word ends, lower case and white space dropped."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in [*self.ids.items(), *self.special.items()]}
        self.parts: dict[int, tuple[int, int]] = {}  # token -> what it was merged from
        self.made: dict[int, int] = {}  # token -> rank of that merge
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b, whole = self.ids[left], self.ids[right], self.ids[left + right]
            self.ranks[a, b] = rank
            if whole in self.parts:
                raise ValueError(f"two merges make {left + right!r}")
            self.parts[whole], self.made[whole] = (a, b), rank
        self.table = dict(enumerate(_byte_symbols()))  # of bytes read as Latin-1
        self.stable_pairs: dict[int, bool] = {}
        usable = {i: s for s, i in self.ids.items() if self._reachable(i)}
        self.inner = {s: i for i, s in usable.items() if not s.endswith(self.end) or i not in self._final_ids()}
        self.final = {s: i for i, s in usable.items() if i in self._final_ids()}
        # Tokens as sequences of symbols; the last symbol of a word carries the word end.
        self.heads = {s[:k] for s in self.inner for k in range(1, len(s) + 1)} | {
            s[:k] for s in self.final for k in range(1, len(s) - len(self.end))}
        self.steps: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
        self.longest_final = max((len(s) - len(self.end) for s in self.final), default=0)
        pieces = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        letters, numbers = _class_of("L"), _class_of("N")
        self.pieces = re.compile(pieces.replace("\\p{L}", letters).replace("\\p{N}", numbers).replace("\\s", _BLANK))
        self.plain = re.compile(r"[a-z]+\Z").match
        self.path, self.unknown = path, re.compile(f"[{_class_of('Cn')}]").search
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    @lru_cache(maxsize=1)  # noqa: B019  (one vocabulary per worker)
    def _final_ids(self) -> frozenset[int]:
        """Tokens that end a word: made of a last symbol, by whatever merges."""
        ends = {i for s, i in self.ids.items() if self.end and s.endswith(self.end) and len(s) == len(self.end) + 1}
        found = set(ends)
        for whole in sorted(self.parts, key=self.made.get):
            if self.parts[whole][1] in found:
                found.add(whole)
        return frozenset(found)

    def _border_holds(self, left: int, right: int, but_last: bool = False) -> bool:
        """Whether no merge crosses the border while both tokens are put together from single symbols.

        The tokens at the border go up from single symbols to ``left`` and ``right`` in the order of their merges;
        of equal merges the leftmost is done first. ``but_last`` lets the finished two merge with each other.
        """
        lefts, rights = [left], [right]
        while lefts[-1] in self.parts:
            lefts.append(self.parts[lefts[-1]][1])
        while rights[-1] in self.parts:
            rights.append(self.parts[rights[-1]][0])
        a, b = len(lefts) - 1, len(rights) - 1
        while True:
            until_a = self.made[lefts[a - 1]] if a else _NEVER
            until_b = self.made[rights[b - 1]] if b else _NEVER
            across = self.ranks.get((lefts[a], rights[b]), _NEVER)
            if across < until_a and across <= until_b:
                return but_last and not a and not b
            if not a and not b:
                return True
            if until_a <= until_b:
                a -= 1
            else:
                b -= 1

    @lru_cache(maxsize=None)  # noqa: B019  (bounded by the vocabulary)
    def _reachable(self, token: int) -> bool:
        """Whether the token's own string is encoded as the token."""
        if token not in self.parts:
            return True
        left, right = self.parts[token]
        return self._reachable(left) and self._reachable(right) and self._border_holds(left, right, but_last=True)

    def _stable(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.stable_pairs.get(key)
        if known is None:
            if len(self.stable_pairs) > 2_000_000:
                self.stable_pairs.clear()
            known = self.stable_pairs[key] = self._border_holds(left, right)
        return known

    def _step(self, grown: str) -> tuple[str, tuple[tuple[int, int], ...]]:
        """Of a string: its longest end that may begin a token, and the tokens it ends in, longest first."""
        known = self.steps.get(grown)
        if known is None:
            if len(self.steps) > 400_000:
                self.steps.clear()
            head = grown
            while head and head not in self.heads:
                head = head[1:]
            found = tuple((len(head) - k, self.inner[head[k:]]) for k in range(len(head)) if head[k:] in self.inner)
            known = self.steps[grown] = (head, found)
        return known

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Token ids of distinct words of byte symbols.

        In sorted order the words are the trie's leaves in depth-first order, so the lists below hold the path
        from the root: for each prefix the head that may grow into a token, and the last token with its length.
        """
        out: dict[str, list[int]] = {}
        steps, stable, final, end = self.steps, self.stable_pairs, self.final, self.end
        heads, lasts, sizes = [""], [-1], [0]
        before = ""
        for word in sorted(words):
            n = len(word)
            shared, most = 0, min(len(before), n - 1, len(heads) - 1)
            if before[:most] == word[:most]:
                shared = most
            else:
                while before[shared] == word[shared]:
                    shared += 1
            del heads[shared + 1:], lasts[shared + 1:], sizes[shared + 1:]
            head = heads[shared]
            for i in range(shared, n - 1):
                grown = head + word[i]
                step = steps.get(grown) or self._step(grown)
                head = step[0]
                for size, token in step[1]:
                    rest = lasts[i + 1 - size]
                    if rest < 0:
                        break
                    holds = stable.get(rest << 20 | token)
                    if self._stable(rest, token) if holds is None else holds:
                        break
                else:
                    raise AssertionError(f"no encoding of {word[:i + 1]!r}")
                heads.append(head)
                lasts.append(token)
                sizes.append(size)
            before = word
            for size in range(min(n, len(head) + 1, self.longest_final), 0, -1):
                token = final.get(word[n - size:] + end)
                if token is not None:
                    rest = lasts[n - size]
                    if rest < 0:
                        break
                    holds = stable.get(rest << 20 | token)
                    if self._stable(rest, token) if holds is None else holds:
                        break
            else:
                raise AssertionError(f"no encoding of {word!r}")
            ids, at = [token], n - size
            while at:
                ids.append(lasts[at])
                at -= sizes[at]
            ids.reverse()
            out[word] = ids
        return out

    def newer(self, part: str) -> list[str]:
        """Words of a run that holds characters newer than Python's tables, parted by the library itself."""
        library = _library(self.path)
        return [word for word, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(part))]

    def words_of(self, chunk: str) -> list[str | int]:
        """Words of a run without white space as byte symbols, and ids of special tokens found in it as they are."""
        if self.plain(chunk):
            return [chunk]
        out: list[str | int] = []
        for part in self.marks.split(chunk) if self.special and "<" in chunk else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part.isascii() and part.isprintable():
                out += self.pieces.findall(part.lower())
            elif self.unknown(part):
                out += self.newer(part)
            else:
                lowered = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                for piece in self.pieces.findall(lowered):
                    out.append(piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.table))
        return out


@lru_cache(maxsize=1)
def _library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes slices of texts and remembers a bounded number of words and of runs without white space."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        self.vocabulary, self.max_words = _vocabulary(path), max_words
        self.known: dict[str, tuple[bytes, str]] = {}
        self.words: dict[str | int, tuple[bytes, str]] = {}

    def _learn(self, chunks: set[str]) -> None:
        v, words = self.vocabulary, self.words
        words_of = {c: v.words_of(c) for c in chunks}
        for word, ids in v.encode_words(list({
            w for found in words_of.values() for w in found if w not in words and isinstance(w, str)
        })).items():
            words[word] = (array("i", ids).tobytes(), " ".join([v.strings[i] for i in ids]))
        for i in v.special.values():
            words[i] = (array("i", [i]).tobytes(), v.strings[i])
        for chunk, found in words_of.items():
            if len(found) == 1:
                self.known[chunk] = words[found[0]]
            else:
                parts = [words[w] for w in found]
                self.known[chunk] = (b"".join([x[0] for x in parts]), " ".join([x[1] for x in parts]))

    def __call__(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids as native 32-bit integers and decoded text of each text."""
        parted = [_SPACE.split(t) if _NOT_SPACE.search(t) else t.split() for t in texts]
        for memory in (self.known, self.words):
            if len(memory) > self.max_words:
                memory.clear()
        new = set().union(*parted).difference(self.known)
        if new:
            self._learn(new)
        known, ids, decoded = self.known, [], []
        for chunks in parted:
            found = [known[c] for c in chunks]
            ids.append(b"".join([x[0] for x in found]))
            decoded.append(" ".join([x[1] for x in found if x[1]]))
        return ids, decoded


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of this worker; what it knows serves the worker's next tasks too."""
    return Encoder(path)


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (array of int), ``n_tokens`` and ``decoded``.

    ``vocabulary`` is the path of a vocabulary file that every executor has.
    """
    kept = [c for c in docs.columns if c not in ("token_ids", "n_tokens", "decoded")]
    rows = spread(docs.select(*[F.col(f"`{c}`") for c in kept]))
    schema = T.StructType([
        *rows.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType()),
    ])

    def work(batches):
        encoder = encoder_of(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(kept.index(text)).to_pylist()]
            for start, end in slices(texts):
                ids, decoded = encoder(texts[start:end])
                sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(sizes),
                     pa.array(decoded, pa.string())],
                    names=[*kept, "token_ids", "n_tokens", "decoded"],
                )

    return rows.mapInArrow(work, schema)


def word_vocabulary() -> str:
    """The vocabulary file that the registered queries use."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query()
def op5_bpe(spark, folder):
    """Digests of the token ids and of the decoded text of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encode(docs, word_vocabulary()).select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
