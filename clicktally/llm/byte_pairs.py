"""Byte-level BPE over a corpus: each distinct word is encoded once.

1. Every stretch of whole documents (about ``chunk_chars`` code points) is cut
   into words; the chunk keeps, per word, the rank of that word among its own
   distinct words (most frequent first), and hands out the distinct words.
2. The words are dealt by their hash, so equal words of all chunks meet, and
   each distinct one is encoded once.
3. The ids travel back to their chunks and are put in the places of the words.

Shuffled are the distinct words of each chunk and the ranks, never the text.
A word that fills the corpus appears once for each chunk, so no key is hot.
Decoding looks the ids up in the table of token bytes, whose size is that of
the vocabulary.

NULL and empty texts have no ids.  Repeated rows and repeated ids of documents
give one result row each.  A document must fit into the memory of a task.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktally.llm.codepoints import SPACE, batched, kinds, points, span_hashes
from clicktally.llm.tables import identified_texts, written

CHUNK_CHARS = 32_000_000
_BLOCK_CHARS = 1_000_000

_PARTS = "chunk long, bucket int, ranks binary, words binary, doc_ids array<long>, n_words array<long>"
_ENCODED = "chunk long, ranks binary, ids binary, doc_ids array<long>, n_words array<long>"
_TOKENS = "doc_id long, ids binary, decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their numbers from a file with one base64 token and one number a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def word_starts(chars: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Where words begin: a run of letters, of digits or of other signs, with one space before it if there
    is one; an English ending after an apostrophe; what is left of white space."""
    if not len(chars):
        return np.zeros(0, np.int64)
    kind = kinds()[chars]
    opens = np.zeros(len(chars) + 1, bool)
    opens[doc_starts] = True
    opens[-1] = True
    edge = opens.copy()
    opens[1:-1] |= kind[1:] != kind[:-1]
    # The last white space before something else stands alone, or goes with it if it is a space.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:-1])
    opens[last] = True
    opens[last[chars[last] == 0x20] + 1] = False
    for ending in ("s", "t", "m", "d", "re", "ve", "ll"):
        at = np.flatnonzero((chars == 0x27) & opens[:-1])
        at = at[at + len(ending) < len(chars)]
        for i, letter in enumerate(ending, 1):
            at = at[(chars[at + i] == ord(letter)) & ~edge[at + i]]
        opens[at + 1] = False
        opens[at + 1 + len(ending)] = True
    return np.flatnonzero(opens[:-1])


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join neighbours, lowest rank and then leftmost first, until no two neighbours form a token."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # of the part that begins here; 0 where none does any more
    before = list(range(-1, n - 1))
    queue = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, left, stop = heapq.heappop(queue)
        right = end[left]
        if not right or right >= n or end[right] != stop:
            continue
        end[left], end[right] = stop, 0
        if stop < n:
            before[stop] = left
            if (rank := ranks.get(word[left : end[stop]])) is not None:
                heapq.heappush(queue, (rank, left, end[stop]))
        if left and (rank := ranks.get(word[before[left] : stop])) is not None:
            heapq.heappush(queue, (rank, before[left], stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


def _packed(numbers: np.ndarray) -> bytes:
    """The four bytes of unsigned numbers, all first bytes together, then all second ones, and so on."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=9).compress(planes.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _packed_words(words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    body = len(words).to_bytes(8, "little") + lengths.tobytes() + b"".join(words)
    return zstandard.ZstdCompressor(level=9).compress(body)


def _unpacked_words(blob: bytes) -> list[bytes]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(body[:8], "little")
    ends = 8 + 4 * n + np.cumsum(np.frombuffer(body, "<u4", n, 8), dtype=np.int64)
    return [body[a:b] for a, b in zip([8 + 4 * n, *ends[:-1].tolist()], ends.tolist(), strict=False)] if n else []


def _pieces(text: str) -> Iterator[str]:
    """Parts of a text of about a block each, cut where white space follows something else: a word ends there."""
    at = 0
    while len(text) - at > _BLOCK_CHARS:
        cut = at + _BLOCK_CHARS
        while cut < len(text) and not (text[cut].isspace() and not text[cut - 1].isspace()):
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def _distinct_words(text: str, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Where each distinct word first stands, its hash, and which of them every word is.

    Words are sorted out by their hashes and then compared sign by sign with the first of the same hash.
    """
    hashes = span_hashes(chars, starts)
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    sizes, model = ends - starts, first[place]
    same = (sizes == sizes[model]).all()
    if not (same and (chars == chars[np.arange(len(chars)) + np.repeat(starts[model] - starts, sizes)]).all()):
        known: dict[str, int] = {}
        own = zip(starts.tolist(), ends.tolist(), strict=True)
        place = np.array([known.setdefault(text[a:b], len(known)) for a, b in own])
        first = np.unique(place, return_index=True)[1]
    return first, hashes[first], place


def _words_of(rows: list[tuple]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """The words of all rows in order, as numbers of distinct words; those words, their hashes, and the
    number of words of each row."""
    order, seen, hashes, counts = [], {}, [], np.zeros(len(rows), np.int64)
    pieces = ((k, piece) for k, (_, text) in enumerate(rows) for piece in _pieces(text))
    for block in batched(pieces, lambda x: len(x[1]), _BLOCK_CHARS):
        text = "".join(piece for _, piece in block)
        sizes = np.array([len(piece) for _, piece in block])
        doc_starts = np.append(0, np.cumsum(sizes))[:-1]
        starts = word_starts(chars := points(text), doc_starts[doc_starts < len(text)])
        owner = np.searchsorted(doc_starts, starts, side="right") - 1
        np.add.at(counts, np.array([k for k, _ in block])[owner], 1)
        ends = np.append(starts[1:], len(text))
        first, found, place = _distinct_words(text, chars, starts, ends)
        numbers = np.empty(len(first), np.int32)
        spans = zip(starts[first].tolist(), ends[first].tolist(), found.tolist(), strict=True)
        for i, (a, b, h) in enumerate(spans):
            if (number := seen.setdefault(text[a:b], len(seen))) == len(hashes):
                hashes.append(h)
            numbers[i] = number
        order.append(numbers[place])
    return np.concatenate([*order, np.zeros(0, np.int32)]), list(seen), np.array(hashes, np.uint64), counts


def _cut(buckets: int, chunk_chars: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        part = TaskContext.get().partitionId()
        for number, chunk in enumerate(batched(rows, lambda row: len(row[1]), chunk_chars)):
            name = (part << 32) + number
            order, words, hashes, counts = _words_of(chunk)
            uses = np.bincount(order, minlength=len(words))
            # Words used once come last, in the order of their use: then 0 says "the next of them".
            often = np.argsort(-uses, kind="stable")[: int((uses > 1).sum())]
            once = uses[order] == 1
            ranked = np.append(often, order[once])
            rank = np.zeros(len(words), np.uint32)
            rank[often] = np.arange(1, len(often) + 1)
            ids = [row[0] for row in chunk]
            out = [(name, None, _packed(np.append(len(often), rank[order])), None, ids, counts.tolist())]
            bucket = (hashes[ranked] >> np.uint64(20)) % np.uint64(buckets)
            for b in np.unique(bucket).tolist():
                places = np.flatnonzero(bucket == b)
                own = [words[k].encode("utf-8", "surrogatepass") for k in ranked[places].tolist()]
                out.append((name, b, _packed(np.diff(places, prepend=0)), _packed_words(own), None, None))
            yield _batch(out, _PARTS)

    return cut


def _encode_words(ranks) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for word in _unpacked_words(row["words"]):
                    if (ids := known.get(word)) is None:
                        ids = known[word] = encode_word(word, ranks.value)
                    out.append(ids)
                lengths = np.fromiter(map(len, out), np.uint32, len(out))
                flat = np.fromiter((i for ids in out for i in ids), np.uint32, int(lengths.sum()))
                packed = _packed(np.concatenate([[len(out)], lengths, flat]))
                yield _batch([(row["chunk"], row["ranks"], packed, None, None)], _ENCODED)

    return encode


def _put_back(token_bytes) -> Callable:
    """The ids of each document of one chunk, and the bytes they stand for."""

    def put_back(parts: pa.Table) -> pa.Table:
        lengths, ids = [], []
        order = None
        for row in parts.to_pylist():
            if row["ids"] is None:
                order = row
                continue
            n, *_ = body = _unpacked(row["ids"])
            lengths.append((np.cumsum(_unpacked(row["ranks"])), body[1 : n + 1].astype(np.int64)))
            ids.append(body[n + 1 :])
        n_ranks = sum(len(r) for r, _ in lengths)
        size, start = np.zeros(n_ranks, np.int64), np.zeros(n_ranks, np.int64)
        base = 0
        for (ranks, own), flat in zip(lengths, ids, strict=True):
            size[ranks] = own
            start[ranks] = base + np.cumsum(own) - own
            base += len(flat)
        pool = np.concatenate([*ids, np.zeros(0, np.uint32)])
        table, ends = token_bytes.value
        often, *_ = words = _unpacked(order["ranks"]).astype(np.int64)
        words = words[1:] - 1
        once = words < 0
        words[once] = often + np.arange(once.sum())
        out, at = [], 0
        for doc_id, n in zip(order["doc_ids"], order["n_words"], strict=True):
            own = words[at : at + n]
            at += n
            tokens = _gathered(pool, start[own], size[own])
            decoded = _gathered(table, ends[tokens] - (width := np.diff(ends, prepend=0)[tokens]), width)
            out.append((doc_id, tokens.astype("<u4").tobytes(), decoded.tobytes()))
        return pa.Table.from_batches([_batch(out, _TOKENS)])

    return put_back


def _gathered(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` that begin at ``start``, one after the other."""
    if not len(size):
        return pool[:0]
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    return pool[shift + np.arange(len(shift))]


_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(field.split() for field in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.record_batch(
        [pa.array(list(c), _ARROW[t]) for c, t in zip(columns, types, strict=True)], names=list(names)
    )


def tokens(
    docs: DataFrame,
    ranks: dict[bytes, int],
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    finish: Callable[[Callable], tuple[Callable, str]] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id``, ``ids`` (little-endian unsigned 32-bit numbers) and ``decoded`` bytes.

    ``finish`` may wrap the last step, to turn ids and bytes into something smaller where they are made.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_id = sorted(ranks.items(), key=lambda item: item[1])
    width = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    width[[rank for _, rank in by_id]] = [len(token) for token, _ in by_id]
    table = (np.frombuffer(b"".join(token for token, _ in by_id), np.uint8), np.cumsum(width))
    send = spark.sparkContext.broadcast

    parts = written(
        identified_texts(docs, id_col, text_col).mapInArrow(_cut(buckets, chunk_chars), _PARTS), "words"
    )
    encoded = (
        parts.filter("bucket is not null")
        .repartition("bucket")
        .mapInArrow(_encode_words(send(ranks)), _ENCODED)
    )
    orders = parts.filter("bucket is null").select("chunk", "ranks", F.lit(None).cast("binary").alias("ids"),
                                                   "doc_ids", "n_words")
    step, schema = _put_back(send(table)), _TOKENS
    if finish:
        step, schema = finish(step)
    return encoded.union(orders).groupBy("chunk").applyInArrow(step, schema)


def _digests(step: Callable) -> tuple[Callable, str]:
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def digest(parts: pa.Table) -> pa.Table:
        rows = step(parts)
        ids, decoded = rows.column("ids").to_pylist(), rows.column("decoded").to_pylist()
        return pa.table({
            "doc_id": rows.column("doc_id"),
            "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
        })

    return digest, schema


def token_digests(docs: DataFrame, ranks: dict[bytes, int], **options) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the sha256 of the ids and of the decoded bytes, one row per document."""
    return tokens(docs, ranks, finish=_digests, **options)
