"""Operator 5, BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be bridged by a
merge, so a text can be cut between the two bytes and the fragments encoded on
their own; their ids are then concatenated.  The table of pairs is made from
the vocabulary.

* A text is normalised and split into words by the tokenizer's own rules.  Each
  word is cut at forced boundaries and each fragment is merged on its own; only
  the last fragment of a word carries the end-of-word mark.
* Fragments repeat far more often than words do, so a worker merges each one
  once and keeps its ids, and those of whole words, in bounded tables.
* If no token holds a white space byte beside another byte and the word rules
  drop white space, every ASCII white space byte is a certain cut too: a long text
  is worked through in blocks that end there.
* Ids are packed as little-endian unsigned 32-bit integers in a BINARY column.

Nulls: a null text encodes as the empty text (no ids, not null); null ids
decode to the empty text.  Repeated rows each keep their row; all other columns
pass through.  The tokenizer file is a parameter, read once by the driver; its
text (a few MB, checked) travels to the executors as a broadcast variable.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from eddyline.llm.common import BLOCK_BYTES, in_slices, once_per_worker

MAX_TOKENIZER_BYTES = 64 << 20     # a larger file is refused, as it is broadcast
TABLE_ENTRIES = 250_000            # words, and fragments, a worker keeps; then it starts anew
TABLE_WORD = 64                    # longer ones are not kept
PLAIN_END = 0x250                  # characters tried for the quick word pattern: Latin


def byte_symbols() -> list[str]:
    """The printable symbol of every byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class ForcedBoundaryBPE:
    """Encoder and decoder for one tokenizer file (JSON text)."""

    def __init__(self, text: str, force: bool = True) -> None:
        spec = json.loads(text)
        model = spec["model"]
        if model.get("type") != "BPE":
            raise ValueError("not a BPE tokenizer")
        self.whole = Tokenizer.from_str(text)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        if any(t.get("normalized") or t.get("single_word") or t.get("lstrip") or t.get("rstrip")
               for t in spec.get("added_tokens") or []):
            raise ValueError("added tokens with matching rules are not supported")
        bare = dict(spec, normalizer=None, pre_tokenizer=None, post_processor=None,
                    decoder=None, added_tokens=[])
        last = Tokenizer.from_str(json.dumps(bare)).model
        inner = (Tokenizer.from_str(json.dumps(
            dict(bare, model=dict(model, end_of_word_suffix=None)))).model if self.suffix else last)
        self.symbols = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(self.symbols)}
        table = np.zeros((256, 256), dtype=np.uint8)
        for token in model["vocab"]:
            body = token[:-len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token
            for x, y in pairwise(body):
                if x in self.byte_of and y in self.byte_of:
                    table[self.byte_of[x], self.byte_of[y]] = 1
        self.bridged = table.astype(bool)
        # One byte for each pair: 1 if some token holds it.  Without forcing, all are 1.
        self.pairs = table.tobytes() if force else b"\1" * 65536
        self.inner, self.last = _Fragments(inner, self.symbols), _Fragments(last, self.symbols)
        names = {i: t for t, i in self.whole.get_vocab(with_added_tokens=True).items()}
        self.names = [names.get(i) for i in range(max(names) + 1)]
        white = [9, 10, 11, 12, 13, 32]
        pre = self.whole.pre_tokenizer
        self.white_cuts = (not self.bridged[white].any() and not self.bridged[:, white].any()
                           and pre is not None
                           and [w for w, _ in pre.pre_tokenize_str(" a \n b\t")] == ["a", "b"])
        self.table = _Words(self)
        self._plain_rules(spec)

    # ---- words ----

    def _plain_rules(self, spec: dict) -> None:
        """A pattern that splits texts of well-known characters as the
        tokenizer does: each character below ``PLAIN_END`` is tried with the tokenizer's own
        normaliser, and those it treats as lower-casing (or as nothing) does are plain."""
        self.odd = None
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        rule = [s["pattern"]["Regex"] for s in steps if s.get("type") == "Split" and s.get("invert")
                and s.get("behavior") == "Removed" and "Regex" in s.get("pattern", {})]
        rest = [s for s in steps if s.get("type") != "Split"]
        if not (self.white_cuts and len(rule) == 1 and len(steps) == 2 and rest[0].get("type") == "ByteLevel"
                and not rest[0].get("use_regex") and not rest[0].get("add_prefix_space")):
            return
        norm = self.whole.normalizer
        same = norm.normalize_str if norm else (lambda c: c)
        self.fold = str.lower if same("A") == "a" else str
        chars = [chr(i) for i in range(PLAIN_END)]
        plain = [c for c in chars if c.isspace() and same(c) == " " or not unicodedata.combining(c)
                 and same(c) == self.fold(c) and unicodedata.is_normalized("NFC", c)]
        escaped = lambda keep: "".join(re.escape(c) for c in chars if keep(c))
        classes = {r"\p{L}": escaped(lambda c: unicodedata.category(c)[0] == "L"),
                   r"\p{N}": escaped(lambda c: unicodedata.category(c)[0] == "N"),
                   r"\s": escaped(lambda c: same(c) == " ")}
        pattern, inside = "", False
        for part in re.split(r"(\\p\{[LN]\}|\\s|\\.|[\[\]])", rule[0]):
            pattern += (classes[part] if inside else f"[{classes[part]}]") if part in classes else part
            inside = inside if part not in ("[", "]") else part == "["
        self.split = re.compile(pattern).findall
        # A character is plain only if the tokenizer also splits it as the pattern does.
        pre = self.whole.pre_tokenizer
        spelt = lambda w: "".join(self.symbols[b] for b in w.encode())
        plain = [c for c in plain if all(
            [w for w, _ in pre.pre_tokenize_str(same(t))] == [spelt(w) for w in self.split(self.fold(t))]
            for t in (c, f"a{c}b", f"1{c}2", f"'{c}.", f"!{c}{c}"))]
        self.odd = re.compile("[^" + "".join(map(re.escape, plain)) + "]").search

    def _words(self, text: str) -> list[str]:
        """The words of a text, by the tokenizer's own rules."""
        norm, pre = self.whole.normalizer, self.whole.pre_tokenizer
        text = norm.normalize_str(text) if norm else text
        return [w for w, _ in pre.pre_tokenize_str(text)] if pre else [text]

    def fragments(self, word: bytes) -> list[bytes]:
        """``word`` cut at every pair of bytes that no token holds."""
        pairs, cuts = self.pairs, [0]
        for i, (x, y) in enumerate(pairwise(word), 1):
            if not pairs[x << 8 | y]:
                cuts.append(i)
        if len(cuts) == 1:
            return [word]
        cuts.append(len(word))
        return [word[a:b] for a, b in pairwise(cuts)]

    def word(self, word: bytes) -> bytes:
        """Packed ids of one word."""
        parts = self.fragments(word)
        end = self.last[parts.pop()]
        return b"".join(map(self.inner.__getitem__, parts)) + end if parts else end

    # ---- texts ----

    def piece(self, text: str) -> bytes:
        """Packed ids of any text, special tokens of the file recognised."""
        out = []
        while text:
            at, name = min(((p, s) for s in self.specials if (p := text.find(s)) >= 0),
                           key=lambda x: (x[0], -len(x[1])), default=(len(text), ""))
            if at:
                out += [self.word(bytes(map(self.byte_of.__getitem__, w))) for w in self._words(text[:at])]
            if name:
                out.append(self.specials[name].to_bytes(4, "little"))
            text = text[at + len(name):]
        return b"".join(out)

    def _block(self, text: str) -> list[bytes]:
        if self.odd is not None and not self.odd(text) and not any(s in text for s in self.specials):
            return list(map(self.table.__getitem__, self.split(self.fold(text))))
        if self.odd is None:
            return [self.piece(c) for c in _ascii_split(text)]
        out = []
        for c in _ascii_split(text):
            if self.odd(c) or any(s in c for s in self.specials):
                out.append(self.piece(c))
            else:
                out += map(self.table.__getitem__, self.split(self.fold(c)))
        return out

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        if not self.white_cuts:
            return self.piece(text)
        out, at = [], 0
        while at < len(text):
            end = at + BLOCK_BYTES
            if end < len(text):
                m = ASCII_WHITE.search(text, end)
                end = m.start() if m else len(text)
            out += self._block(text[at:end])
            at = end
        for held in (self.table, self.inner, self.last):
            if len(held) > TABLE_ENTRIES:
                held.clear()
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; ids that the vocabulary lacks give nothing."""
        ids = np.frombuffer(packed, dtype="<u4")
        if len(ids) and int(ids.max()) >= len(self.names):
            ids = ids[ids < len(self.names)]
        names = list(map(self.names.__getitem__, ids.tolist()))
        if None in names:
            names = [n for n in names if n is not None]
        return self.whole.decoder.decode(names) if self.whole.decoder else " ".join(names)


ASCII_WHITE = re.compile(r"[\x20\x09-\x0d]")


def _ascii_split(text: str) -> list[str]:
    return [c.decode() for c in text.encode().split()]


class _Words(dict):
    """Packed ids of words already met."""

    def __init__(self, coder: ForcedBoundaryBPE) -> None:
        self.coder = coder

    def __missing__(self, word: str) -> bytes:
        ids = self.coder.word(word.encode())
        if len(word) <= TABLE_WORD:
            self[word] = ids
        return ids


class _Fragments(dict):
    """Packed ids of fragments already merged."""

    def __init__(self, model, symbols: list[str]) -> None:
        self.model, self.symbols = model, symbols

    def __missing__(self, fragment: bytes) -> bytes:
        found = self.model.tokenize("".join(map(self.symbols.__getitem__, fragment)))
        ids = np.array([t.id for t in found], dtype="<u4").tobytes()
        if len(fragment) <= TABLE_WORD:
            self[fragment] = ids
        return ids


def _coder(shared) -> ForcedBoundaryBPE:
    """The worker's coder for a broadcast tokenizer text."""
    text = shared.value
    return once_per_worker(("bpe", len(text), hash(text)), lambda: ForcedBoundaryBPE(text))


def share_tokenizer(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(text) > MAX_TOKENIZER_BYTES:
        raise ValueError("the tokenizer file is too large to broadcast")
    return spark.sparkContext.broadcast(text)


def _udf(kind: T.DataType, arrow: pa.DataType, shared, each):
    @F.arrow_udf(kind)
    def f(col: pa.Array) -> pa.Array:
        coder = _coder(shared)
        return in_slices(col, lambda x: each(coder, x), arrow)
    return f


def encode_column(shared, text: str | Column) -> Column:
    """Packed ids (BINARY) of a text column."""
    return _udf(T.BinaryType(), pa.binary(), shared, lambda coder, x: coder.encode(x or ""))(text)


def count_column(shared, text: str | Column) -> Column:
    """Number of tokens of a text column; the ids stay in the worker."""
    return _udf(T.LongType(), pa.int64(), shared, lambda coder, x: len(coder.encode(x or "")) // 4)(text)


def decode_column(shared, ids: str | Column) -> Column:
    """The text of a column of packed ids."""
    return _udf(T.StringType(), pa.string(), shared, lambda coder, x: coder.decode(x or b""))(ids)


def encode_documents(docs: DataFrame, tokenizer: str, text_col: str = "text",
                     ids_col: str = "token_ids", count_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the packed ids and their number (existing columns of these
    names are replaced)."""
    shared = share_tokenizer(docs.sparkSession, tokenizer)
    out = docs.withColumn(ids_col, encode_column(shared, F.col(f"`{text_col}`")))
    return out.withColumn(count_col, F.expr(f"octet_length(`{ids_col}`) div 4").cast("bigint"))


def decode_documents(docs: DataFrame, tokenizer: str, ids_col: str = "token_ids",
                     out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of the packed ids."""
    shared = share_tokenizer(docs.sparkSession, tokenizer)
    return docs.withColumn(out_col, decode_column(shared, F.col(f"`{ids_col}`")))


def unpack_ids(packed: bytes) -> list[int]:
    return np.frombuffer(packed, dtype="<u4").tolist()
