"""SentencePiece encoding and decoding: shared-prefix Viterbi over a trie of marked words.

A marked word begins with the space mark; no piece holds a mark after another character, so words are encoded apart. The distinct words
of a batch are sorted, which lays out their trie depth-first: a word keeps the forward states of the prefix it shares with the one before it
and only computes the rest. The state of a prefix is the last piece of its best segmentation.

The public model is a merge model, whose segmentation is not the one of largest total score. The forward pass keeps its
meaning by what it admits: a piece may follow another only if the merges of the two together give just these two. Exactly one
segmentation of every prefix passes, and it is the model's own, so results equal the library's.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptloom.llm.tokens import default_path

MARK = "▁"
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Pieces:
    """A vocabulary: ids and merge ranks of pieces, and the bytes behind each id."""

    # A character without a piece counts as this plus its code point.
    UNKNOWN = 1 << 19

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.ids, self.rank, self.bytes, self.byte_ids = {}, {}, [], {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes.append(b"")
            else:
                self.ids[piece], self.rank[piece] = i, -model.get_score(i)
                self.bytes.append(piece.encode())
        self.names = {i: p for p, i in self.ids.items()}
        # A place in a text is known by the longest beginning of a piece that ends there, which tells all pieces that end there. Places are
        # numbered, and steps from one to the next found, as texts need them.
        self.beginnings = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        self.places, self.numbers, self.steps, self.ends = [""], {"": 0}, [{}], [()]
        self.beside = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.whole = {i for p, i in self.ids.items() if self.merged(p) == [p]}
        self.pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by its merges: always the leftmost pair of the best rank."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                rank = self.rank.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def step(self, place: int, char: str) -> int:
        """The place after a character; ``ends`` of it are (id, length) of the pieces that end there, from long to short."""
        known = self.places[place] + char
        while known and known not in self.beginnings:
            known = known[1:]
        number = self.numbers.get(known)
        if number is None:
            number = self.numbers[known] = len(self.places)
            self.places.append(known)
            self.steps.append({})
            self.ends.append(tuple((self.ids[known[k:]], len(known) - k) for k in range(len(known)) if known[k:] in self.ids))
        self.steps[place][char] = number
        return number

    def follows(self, left: int, right: int) -> bool:
        """Whether the merges of two pieces together give just these two. Characters without a piece never merge."""
        if left >= self.UNKNOWN or right >= self.UNKNOWN:
            return True
        a, b = self.names[left], self.names[right]
        if a[-1] + b[0] not in self.beside:
            # No merge can cross, so each is what its own merges give.
            return left in self.whole and right in self.whole
        return self.merged(a + b) == [a, b]

    def encode_sorted(self, words: list[str]) -> Iterator[tuple[str, array]]:
        """Ids of distinct words in sorted order. ``states[i]`` is (shifted id of the last piece, its start, place) of the first i characters."""
        states: list[tuple[int, int, int]] = [(-1, -1, 0)]
        before, whole, pairs, unknown, steps, ends = "", self.whole, self.pairs, self.UNKNOWN, self.steps, self.ends
        if len(pairs) > 1_000_000:
            pairs.clear()
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del states[shared + 1 :]
            place, i = states[shared][2], shared
            for char in word[shared:]:
                i += 1
                after = steps[place].get(char)
                place = self.step(place, char) if after is None else after
                for piece, length in ends[place]:
                    j = i - length
                    if not j:
                        if piece in whole:
                            break
                        continue
                    last = states[j][0]
                    fits = pairs.get(last | piece)
                    if fits is None:
                        fits = pairs[last | piece] = self.follows(last >> 21, piece)
                    if fits:
                        break
                else:
                    if char in self.ids:
                        raise AssertionError(f"no segmentation of {word[:i]!r}")
                    piece, j = unknown + ord(char), i - 1
                states.append((piece << 21, j, place))
            ids = []
            while i:
                piece, i, _ = states[i]
                piece >>= 21
                if piece < unknown:
                    ids.append(piece)
                else:
                    ids.extend(self.byte_ids[b] for b in reversed(chr(piece - unknown).encode("utf-8", "surrogatepass")))
            yield word, array("i", ids[::-1])
            before = word

    def decode(self, ids) -> str:
        """The text of ids: their bytes without the leading mark, marks as spaces; broken sequences give replacement characters."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def pieces(path: str | None = None) -> Pieces:
    return Pieces(path or default_path("piece_bpe_32k.model"))


def marked_words(text: str) -> list[str]:
    """Marked words of a text: runs of marks with the characters up to the next mark."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
        return _WORDS.findall(MARK + text.replace(" ", MARK))
    return [MARK + w for w in text.split(" ")]


class Words(dict):
    """Ids of words that a worker met before, in whatever task, as bytes of 32-bit integers, up to a bounded number."""

    def __init__(self, model: Pieces, most: int):
        super().__init__()
        self.model, self.most = model, most

    def learn(self, words: set[str]) -> None:
        new = words.difference(self)
        if len(self) + len(new) > self.most:
            self.clear()
            new = words
        self.update((word, ids.tobytes()) for word, ids in self.model.encode_sorted(sorted(new)))


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``most`` bytes together, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(batch):
        yield batch.slice(start)


@lru_cache(maxsize=1)
def remembered(path: str | None, most: int) -> Words:
    return Words(pieces(path), most)


def encode(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str | None = None, remember: int = 600_000) -> DataFrame:
    """The columns of ``keep``, then ``ids`` (array of int) and ``exact``: whether they decode to the text.

    Texts are encoded whole and decoded again in the task that encoded them. A null text gives null ids and ``exact``, an empty one no ids. A text
    that holds the space mark itself decodes to spaces, as with any use of the model, so ``exact`` is false there. Repeated rows give equal ids; no documents
    give no rows; columns not in ``keep`` are not read. ``remember`` bounds the words a worker remembers.
    """
    schema = docs.select(*keep).schema.add("ids", T.ArrayType(T.IntegerType())).add("exact", T.BooleanType())
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = pieces(path), remembered(path, remember)
        for whole in batches:
            # Words of many texts together share more of their prefixes.
            for batch in slices(whole, width):
                texts = batch.column(width).to_pylist()
                marked = [[] if t is None else marked_words(t) for t in texts]
                known.learn({w for ws in marked for w in ws})
                coded = [b"".join([known[w] for w in ws]) for ws in marked]
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])])
                ids = np.frombuffer(b"".join(coded), np.int32)
                exact = [None if t is None else model.decode(ids[a:b].tolist()) == t for t, a, b in zip(texts, offsets, offsets[1:])]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids), mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], lists, pa.array(exact, pa.bool_())], [*schema.names])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def decode(ids: Column, path: str | None = None) -> Column:
    """Texts of a column of ids; null for null."""
    @F.pandas_udf("string")
    def run(values):
        model = pieces(path)
        return values.map(lambda x: None if x is None else model.decode(x))

    return run(ids)
