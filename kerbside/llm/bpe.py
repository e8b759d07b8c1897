"""Byte-level BPE: a backtracking encoder and a decoder over an offset table.

Encoding takes the longest token at each position (all token matches of a piece come from one
Aho-Corasick pass) and accepts it only if it is compatible with the token before it, that is if the
merges would not have joined or cut the two in another way. Where nothing fits, the last token is
taken back and replaced by its longest shorter prefix. A position that failed once is never tried
again, so a piece costs time in proportion to its length, and the result is that of running all
merges in order.

Results: a null text is encoded as an empty text; an empty text has no ids; null ids decode to
null. Ids outside the vocabulary are an error. Strings of added tokens inside a text become their
ids, and decode to themselves.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import text_column

# Fixed value: the splitting pattern of the tokenizer family.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Texts of these characters alone split alike with plain classes, which run several times faster.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\t-\r -~{_LETTERS}]*")
_PLAIN_PIECES = re.compile(
    PIECES.replace(r"\p{L}", "§L§").replace(r"\p{N}", "§N§")
    .replace("[^\\s§L§§N§]", rf"[^\s{_LETTERS}0-9]").replace("§L§", f"[{_LETTERS}]").replace("§N§", "[0-9]")
)
#: A blank before white space or at the end joins a run, so splitting at blanks would cut it.
_JOINED = re.compile(r" \s| $")
#: Words and pieces remembered in a task, in each of two generations.
REMEMBERED = 100_000


def _byte_letters() -> dict[str, int]:
    """The vocabulary spells bytes as printable characters; those that print stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(b): b for b in shown}
    spelled.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))})
    return spelled


class Vocabulary:
    """Tokens, merges and the tables that both directions need."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        spelled, model = _byte_letters(), spec["model"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        tokens = {bytes(spelled[c] for c in s): i for s, i in model["vocab"].items() if s not in self.added}
        self.size = max([*tokens.values(), *self.added.values()]) + 1
        self.texts: list[bytes] = [b""] * self.size
        for text, i in [*tokens.items(), *((s.encode(), i) for s, i in self.added.items())]:
            self.texts[i] = text
        #: Rank of the merge that makes a pair, and for each token its rank, halves and length.
        self.merged: dict[tuple[int, int], int] = {}
        self.rank = [-1] * self.size
        self.halves = [(i, i) for i in range(self.size)]
        self.length = [len(t) for t in self.texts]
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (tokens[bytes(spelled[c] for c in s)] for s in (left, right))
            whole = tokens[self.texts[a] + self.texts[b]]
            if self.rank[whole] < 0:
                self.merged[a, b] = rank
                self.rank[whole] = rank
                self.halves[whole] = (a, b)
        reachable = {t: i for t, i in tokens.items() if len(t) == 1 or self.rank[i] >= 0}
        self.shorter = [-1] * self.size
        self.machine = ahocorasick.Automaton()
        for text, i in reachable.items():
            self.machine.add_word(text.decode("latin-1"), (i, len(text)))
            self.shorter[i] = next((reachable[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in reachable), -1)
        self.machine.make_automaton()
        self.offsets = np.zeros(self.size + 1, np.int64)
        np.cumsum(self.length, out=self.offsets[1:])
        self.buffer = np.frombuffer(b"".join(self.texts), np.uint8)
        self.compatible: dict[int, bool] = {}
        self.splitter = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens ends in just these two; remembered by pair."""
        key = left * self.size + right
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) >= 2_000_000:
                self.compatible.clear()
            known = self.compatible[key] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        """Unfold both tokens, last merge first: a merge across the seam that comes before the
        merges that hide it would have happened, so the pair could not have stayed apart."""
        rank, halves, merged = self.rank, self.halves, self.merged
        before = len(merged) + 1
        while True:
            across = merged.get((left, right))
            if across is not None and across < before:
                return False
            # The later of the two top merges is undone first. At equal ranks (both sides the same
            # token) merges run from left to right, so the right side is undone first.
            if rank[left] > rank[right]:
                before = rank[left]
                left = halves[left][1]
            elif rank[right] >= 0:
                before = rank[right] + 1
                right = halves[right][0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        letters = piece.decode("latin-1")
        length, shorter, size, known, fits = self.length, self.shorter, self.size, self.compatible.get, self.fits
        # Every byte is a token, so the leftmost longest matches cover the piece: where all
        # neighbours are compatible, nothing is ever taken back and they are the result.
        out = [token for _, (token, _) in self.machine.iter_long(letters)]
        last = -1
        for token in out:
            if last >= 0:
                ok = known(last * size + token)
                if not (fits(last, token) if ok is None else ok):
                    break
            last = token
        else:
            return out
        n = len(piece)
        longest = [0] * n
        for end, (token, count) in self.machine.iter(letters):
            longest[end - count + 1] = token  # ends ascend, so the last match is the longest
        open_at = [True] * (n + 1)
        out = []
        at, token = 0, longest[0]
        while at < n:
            end = at + length[token]
            ok = open_at[end]
            if ok and out:
                ok = known(out[-1] * size + token)
                if ok is None:
                    ok = fits(out[-1], token)
            if ok:
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                open_at[at] = False
                token = out.pop()
                at -= length[token]
        return out

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without added tokens; merges never cross their borders."""
        return (_PLAIN_PIECES if _PLAIN.fullmatch(text) else _any_piece()).findall(text)

    def decode(self, ids: np.ndarray) -> bytes:
        """Gather the bytes of all tokens at once: where each token lies is in the offset table."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        length = self.offsets[ids + 1] - start
        ends = np.cumsum(length)
        at = np.arange(ends[-1], dtype=np.int64) + np.repeat(start - (ends - length), length)
        return self.buffer[at].tobytes()


@lru_cache(1)
def _any_piece() -> regex.Pattern:
    # The pattern's white space is Unicode's property; str.isspace has four separators more.
    return regex.compile(PIECES.replace("[^\\s", "[^\\p{White_Space}").replace("\\s", "\\p{White_Space}").replace("\\S", "\\P{White_Space}"))


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Remembered(dict):
    """Results of a function; keeps two generations, so memory is bounded and common keys stay."""

    def __init__(self, function: Callable[[str], bytes]):
        super().__init__()
        self.function, self.old = function, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.function(key)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Encoder:
    """Encodes texts; ids of words that follow a blank, and of pieces, are remembered as bytes."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.pieces = _Remembered(lambda piece: array("i", vocab.encode_piece(piece.encode("utf-8"))).tobytes())
        self.words = _Remembered(lambda word: self._plain(" " + word))

    def _plain(self, text: str) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[p] for p in self.vocab.pieces(text)])

    def _part(self, text: str) -> bytes:
        if _JOINED.search(text):
            return self._plain(text)
        first, *rest = text.split(" ")
        words = self.words
        return self._plain(first) + b"".join([words[w] for w in rest])

    def __call__(self, text: str) -> np.ndarray:
        vocab = self.vocab
        if vocab.splitter is None or not vocab.splitter.search(text):
            return np.frombuffer(self._part(text), np.int32)
        parts = []
        for k, part in enumerate(vocab.splitter.split(text)):
            if k % 2:
                parts.append(np.array([vocab.added[part]], np.int32).tobytes())
            elif part:
                parts.append(self._part(part))
        return np.frombuffer(b"".join(parts), np.int32)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))


def encode(documents: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<int>) of every text; `path` is the tokenizer's JSON file on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            first = 0
            while first < batch.num_rows:  # a result of bounded size at a time
                rows, total = [], 0
                while first + len(rows) < batch.num_rows and (not rows or total < 1_000_000):
                    rows.append(encoder(texts[first + len(rows)].as_py()))
                    total += len(rows[-1])
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(rows)), _lists(rows)], ["doc_id", "ids"])
                first += len(rows)

    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<int>")


def sizes(texts: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """The rows with the number of ids of the text, which may not be null, in place of the text."""
    at = texts.columns.index(text_col)
    schema = T.StructType([*(f for f in texts.schema.fields if f.name != text_col), T.StructField(out_col, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))
        for batch in batches:
            counts = pa.array([len(encoder(text.as_py())) for text in batch.column(at)], pa.int64())
            columns = [*batch.columns[:at], *batch.columns[at + 1 :], counts]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return texts.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Append the text that the ids stand for; bytes that are no UTF-8 become replacement characters."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            offsets = np.asarray(column.offsets).astype(np.int64)
            values = np.asarray(column.values).astype(np.int64)
            valid = column.is_valid().to_numpy(zero_copy_only=False)
            texts = [
                vocab.decode(values[offsets[k] : offsets[k + 1]]).decode("utf-8", "replace") if valid[k] else None
                for k in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out_col])

    return encoded.mapInArrow(run, schema)
