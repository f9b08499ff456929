"""Token sequences of one length, packed by best fit.

Texts become token ids; what has no white space between is encoded once for each
task that meets it, without the punctuation at its end, and the ids of a text are
gathered from there.  Every task
packs the documents it reads in stretches of about ``chunk_tokens``:

1. A document of more tokens than a window is cut into full windows and a rest.
2. Rests and short documents are placed by decreasing length, each into the open
   window whose remaining room fits it most tightly.  A segment tree over the
   remaining room counts the open windows and finds that room by one descent.
3. Windows left open are filled up: the fullest takes tokens off the emptiest,
   so that one open window remains.  It is cut at powers of two, which need no
   padding.  ``fill_up=False`` leaves the windows as the second step made them.

Nothing is shuffled and no task waits for another, so a lost task only packs its
own documents again.  Which documents share a sequence follows from how Spark
deals the input into tasks.  A task holds one stretch and one document.

Defined results: a NULL or empty text is one end mark.  Repeated rows and rows
without a number are documents of their own.  Strings of special tokens are
ordinary text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.codepoints import batched
from clicktally.llm.tables import identified_texts

WINDOW = 2048
CHUNK_TOKENS = 4_000_000
_BLOCK_BYTES = 2_000_000
_KNOWN_WORDS, _KNOWN_BYTES = 1_000_000, 32_000_000

_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: Letters, digits and punctuation at the end are never in one token, so these are encoded apart.
#: Of other letters than ASCII those of Latin-1 are looked at; they are one sign each.
_WITH_SIGNS = re.compile(rb"(.*(?:[0-9A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([!-/:-@\[-`{-~]+)", re.DOTALL)
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

#: A piece of a document: its place in the stretch, the first token, the number of tokens.
Piece = tuple[int, int, int]


class Encoder:
    """The ids of texts, by the library, for each run of bytes without ASCII white space once."""

    #: Stands between words that are encoded in one call; its id tells them apart, as no other byte gives it.
    BETWEEN = b"\0"
    WORDS_A_CALL = 500

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = self._tokenizer(model)
        # Small letters of ASCII and Latin-1 are one word, as they are, to every pattern and form: here without these.
        signs = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        plain = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, signs]}
        self.of_letters = self._tokenizer(json.dumps(json.loads(model) | {"normalizer": None, "pre_tokenizer": plain}))
        (self.between,) = self._encoded(self.library, [self.BETWEEN.decode()])[0].ids
        self._forget()

    @staticmethod
    def _tokenizer(model: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(model)
        library.encode_special_tokens = True
        library.model._resize_cache(0)  # it is given each word once
        return library

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        self.pool, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encoded(self, library, texts: list[str]) -> list:
        return library.encode_batch_fast(texts, add_special_tokens=False)

    def _known(self, words: list[bytes], ids: list[np.ndarray], sizes: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.known_bytes += sum(map(len, words))
        self.pool, self.sizes = np.concatenate([self.pool, *ids]), np.concatenate((self.sizes, sizes))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _learn_whole(self, library, words: list[bytes]) -> None:
        plain = [w for w in words if self.BETWEEN not in w]
        rest = [w for w in words if self.BETWEEN in w]
        glue = b" " + self.BETWEEN + b" "
        lots = [plain[i : i + self.WORDS_A_CALL] for i in range(0, len(plain), self.WORDS_A_CALL)]
        texts = [(glue.join(lot) + glue).decode("utf-8", "replace") for lot in lots]
        ids = np.concatenate([np.zeros(0, np.uint32), *[np.array(e.ids, np.uint32) for e in self._encoded(library, texts)]])
        last = np.flatnonzero(ids == self.between)
        sizes, own = np.diff(last, prepend=-1) - 1, [ids[ids != self.between]]
        for e in self._encoded(library, [w.decode("utf-8", "replace") for w in rest]):
            sizes = np.append(sizes, len(e.ids))
            own.append(np.array(e.ids, np.uint32))
        self._known(plain + rest, own, sizes)

    def _learn(self, words: set[bytes]) -> None:
        ended = {w: found.groups() for w in words if (found := _WITH_SIGNS.fullmatch(w))}
        whole = words.difference(ended).union(chain.from_iterable(ended.values())).difference(self.known)
        letters = [w for w in whole if _LETTERS.fullmatch(w)]
        self._learn_whole(self.of_letters, letters)
        self._learn_whole(self.library, list(whole.difference(letters)))
        parts = np.fromiter(map(self.known.__getitem__, chain.from_iterable(ended.values())), np.int64, 2 * len(ended))
        self._known(list(ended), [self._ids(parts)], self.sizes[parts].reshape(-1, 2).sum(axis=1))

    def _ids(self, words: np.ndarray) -> np.ndarray:
        """The ids of known words, one after the other."""
        width = self.sizes[words]
        ends = np.cumsum(width)
        return self.pool[np.repeat(self.starts[words] - (ends - width), width) + np.arange(int(width.sum()))]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > _KNOWN_WORDS or self.known_bytes > _KNOWN_BYTES:
            self._forget()
        # The model lower-cases every letter; in front of an accent of its own that is not the same beforehand.
        split = [(text.lower() if text.isascii() else text).split() for text in texts]
        if fresh := set().union(*split).difference(self.known):
            self._learn(fresh)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        words = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        ends = np.append(0, np.cumsum(self.sizes[words]))[np.cumsum(counts)]
        return np.split(self._ids(words), ends[:-1]) if texts else []


@lru_cache(maxsize=1)
def _encoder(model: str) -> Encoder:
    """One for each Python worker, which serves many tasks."""
    return Encoder(model)


class RoomTree:
    """Open windows by their remaining room: a segment tree of counts over the rooms 0 to ``window``."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: dict[int, list[int]] = {}

    def add(self, room: int, window: int) -> None:
        self.open.setdefault(room, []).append(window)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += by
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Room and number of the open window of the least room that is at least ``need``, taken out; None without one."""
        node = need + self.leaves
        if not self.counts[node]:
            # Up to the first subtree on the right that holds a window, then down to its leftmost one.
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node <<= 1
                node += not self.counts[node]
        room = node - self.leaves
        window = self.open[room].pop()
        self._change(room, -1)
        return room, window


def best_fit(sizes: list[int], window: int) -> list[list[Piece]]:
    """Windows of pieces: full windows first, then the rests by decreasing size, each where it fits most tightly."""
    full, rests = [], []
    for k, size in enumerate(sizes):
        cut = size - size % window
        full += [[(k, start, window)] for start in range(0, cut, window)]
        if size > cut:
            rests.append((k, cut, size - cut))
    tree, opened = RoomTree(window), []
    for piece in sorted(rests, key=lambda p: (-p[2], p[0])):
        room, place = tree.tightest(piece[2]) or (window, len(opened))
        if place == len(opened):
            opened.append([])
        opened[place].append(piece)
        if room > piece[2]:
            tree.add(room - piece[2], place)
    return full + opened


def filled_up(windows: list[list[Piece]], window: int) -> list[list[Piece]]:
    """The same tokens with all windows full, but for some at the end whose sizes are falling powers of two."""
    used = [sum(n for *_, n in pieces) for pieces in windows]
    out = [pieces for pieces, size in zip(windows, used, strict=True) if size == window]
    by_room = sorted((i for i in range(len(windows)) if used[i] < window), key=lambda i: -used[i])
    low, high = 0, len(by_room) - 1  # the fullest that is open, the emptiest that has tokens left
    fresh = {i: list(windows[i]) for i in by_room}
    while low < high:
        taker, giver = by_room[low], by_room[high]
        room = window - used[taker]
        k, start, n = fresh[giver].pop()
        moved = min(room, n)
        if moved < n:
            fresh[giver].append((k, start, n - moved))
        fresh[taker].append((k, start + n - moved, moved))
        used[taker] += moved
        used[giver] -= moved
        if used[taker] == window:
            out.append(fresh[taker])
            low += 1
        if not used[giver]:
            high -= 1
    if low == high:
        out += _powers_of_two(fresh[by_room[low]], used[by_room[low]])
    return out


def _powers_of_two(pieces: list[Piece], size: int) -> list[list[Piece]]:
    """The pieces of one window cut into windows of falling powers of two."""
    out, left = [], list(reversed(pieces))
    for power in (1 << bit for bit in reversed(range(size.bit_length())) if size >> bit & 1):
        own, room = [], power
        while room:
            k, start, n = left.pop()
            taken = min(n, room)
            own.append((k, start, taken))
            if taken < n:
                left.append((k, start + taken, n - taken))
            room -= taken
        out.append(own)
    return out


def _documents(batches: Iterator[pa.RecordBatch], encoder: Encoder, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for block in batched(rows, lambda row: len(row[1]), _BLOCK_BYTES):
            for (doc_id, _), ids in zip(block, encoder.encode([text for _, text in block]), strict=True):
                yield doc_id, np.append(ids, np.uint32(end_id))


def _packed(model, window: int, end_id: int, chunk_tokens: int, fill_up: bool) -> Callable:
    def rows_of(chunk: list[tuple], first: int) -> Iterator[tuple]:
        sizes = [len(ids) for _, ids in chunk]
        windows = best_fit(sizes, window)
        for number, pieces in enumerate(filled_up(windows, window) if fill_up else windows, first):
            offset = 0
            for k, start, n in pieces:
                doc_id, ids = chunk[k]
                yield doc_id, start, n, ids[start : start + n].astype("<u4").tobytes(), sizes[k], number, offset
                offset += n

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        documents = _documents(batches, _encoder(model.value), end_id)
        for chunk in batched(documents, lambda row: len(row[1]), chunk_tokens):
            rows = list(rows_of(chunk, number))
            number = rows[-1][5] + 1
            yield _as_batch(rows)

    return packed


def _as_batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(field.split() for field in _PIECES.split(", ")), strict=True)
    types = [pa.binary() if kind == "binary" else pa.int64() for kind in kinds]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


def packed_pieces(
    docs: DataFrame,
    tokenizer_json: str,
    window: int = WINDOW,
    end_id: int = 1,
    chunk_tokens: int = CHUNK_TOKENS,
    fill_up: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (its document's tokens before it), ``length``, ``ids`` (little-endian
    unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id`` and ``offset`` (tokens before it in the sequence).

    ``tokenizer_json`` is the text of a tokenizer's file; its size is that of a vocabulary.
    """
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    texts = identified_texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_packed(model, window, end_id, chunk_tokens, fill_up), _PIECES)


def sequences(pieces: DataFrame, window: int = WINDOW, padding_id: int = 0) -> DataFrame:
    """``sequence_id``, ``n_tokens``, ``ids``: the sequences, padded to ``window`` unless a power of two.

    A sequence has at most ``window`` pieces.
    """
    own = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    joined = F.aggregate("parts", F.lit(b""), lambda a, part: F.concat(a, part["ids"]))
    missing = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(window - F.col("n_tokens")).cast("int")
    padding = F.unhex(F.repeat(F.lit(padding_id.to_bytes(4, "little").hex()), missing))
    return own.select("sequence_id", "n_tokens", F.concat(joined, padding).alias("ids"))
