"""Operator 12: alignment of two tokenizers' tokens by interval coalescing.

A text with a space before it is tokenised by a byte-level file (A) and, without the space, by a
sentencepiece file (B, which adds it).  All A and B tokens of a batch of texts are sorted
together by their first byte; where a start reaches the running maximum of the ends, a group
begins, and within a group every overlapping A-B pair is a link.  A link's count is the number
of links corpus-wide with its id pair.

Spark does the counting.  Texts are tokenised once, in blocks of about ``BLOCK_LINKS`` links
(written as a table in the shared folder); a block lists its distinct pairs once, with their totals, and each
of its links as a place in that list.  Only the lists are shuffled to count pairs, to find the highest
count of each B id, and to bring the counts back to their blocks, so neither the corpus's pairs nor a
hot pair ever meet in one task: a pair has one row a block.  Each block then adds up its documents.

Defined cases: null and empty texts, and texts whose tokens' bytes do not give the text back (a
literal U+2581, for one), have zeros and empty groups; every row of ``docs`` gives one
row, also with null or repeated ids; an empty table gives no rows.  A document is one task's work.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from callsmith.llm.common import shared_path
from callsmith.llm.tokenizing import byte_letters, encoder, stretches

BLOCK_LINKS = 1 << 21   # links of a block, from which on it is closed
BATCH_CHARS = 1 << 20   # of texts that are aligned together
SLICE_CHARS = 1 << 21   # of texts whose A ids are looked up together
GROUP_BYTES = 1 << 24   # of a row group of the written blocks, whose size is looked at after every block
SUM_LINKS = 1 << 18     # links that are added up together

BLOCKS = ("block bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
          "n_links array<bigint>, groups array<string>, pairs array<bigint>, totals array<bigint>, links binary")
ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
           "count_sum bigint, groups_sha256 string")


def coalesce(start_a, end_a, start_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers (from 0, in byte order) of A and of B tokens: groups of intervals that overlap in a chain."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((np.arange(len(start)) >= len(start_a), start))
    reached = np.maximum.accumulate(end[order]) if len(order) else end
    begins = np.ones(len(order), bool)
    begins[1:] = start[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(begins) - 1
    return group[:len(start_a)], group[len(start_a):]


def overlaps(start_a, end_a, start_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of every pair of overlapping tokens; each side is in byte order and gapless."""
    first = np.searchsorted(end_b, start_a, "right")
    each = np.searchsorted(start_b, end_a, "left") - first
    a = np.repeat(np.arange(len(start_a)), each)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(each) - each - first, each)


class Aligner:
    """Both tokenizers, and the bytes of their entries."""

    def __init__(self, bytes_file: str, pieces_file: str):
        from sentencepiece import SentencePieceProcessor

        self.encoder = encoder(bytes_file, False)
        self.pieces = SentencePieceProcessor(model_file=pieces_file)
        byte_of = {letter: b for b, letter in byte_letters().items()}
        vocab = self.encoder.tokenizer.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            if all(c in byte_of for c in entry):
                self.bytes_a[i] = bytes(byte_of[c] for c in entry)
        self.bytes_b = [self._piece_bytes(i) for i in range(self.pieces.vocab_size())]
        # Each id's text with what may follow it: first those of A (, or |), then those of B (, or ;).
        self.said = _Strings([b"%d%s" % (i, after) for count, marks in ((len(self.bytes_a), (b",", b"|")),
                                                                        (len(self.bytes_b), (b",", b";")))
                              for i in range(count) for after in marks])
        self.said_a, self.said_b = _Strings(self.bytes_a), _Strings(self.bytes_b)

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        if self.pieces.is_control(i) or self.pieces.is_unknown(i) or self.pieces.is_unused(i):
            return b""
        return piece.replace("▁", " ").encode()

    def ids_a(self, texts: list[str | None]) -> list[np.ndarray]:
        """The A ids of each text after a space."""
        ids, sizes = self.encoder.batch(texts, space=True)
        return np.split(ids.astype(np.int32), np.cumsum(sizes)[:-1]) if texts else []

    def align(self, texts: list[str | None], ids_a: list[np.ndarray] | None = None):
        """(n_a, n_b, n_groups, n_links, groups' digest of each text, pair of each link in text order)."""
        n = len(texts)
        counts = np.zeros((4, n), np.int64)
        digests = [""] * n
        some = [i for i, t in enumerate(texts) if t]
        ids_b = self.pieces.encode([texts[i] for i in some], num_threads=1) if some else []
        ids_b = [np.array(b, np.int32) for b in ids_b]
        ids_a = self.ids_a([texts[i] for i in some]) if ids_a is None else [ids_a[i] for i in some]
        kept, all_a, all_b = [], [], []
        for i, a, b, bytes_a, bytes_b in zip(some, ids_a, ids_b, self.said_a.joined(ids_a), self.said_b.joined(ids_b)):
            raw = (" " + texts[i]).encode()
            if bytes_a == raw and bytes_b == raw:
                kept.append(i)
                all_a.append(a)
                all_b.append(b)
        if not kept:
            return counts, digests, np.zeros(0, np.int64)
        ends_a, ends_b = (np.cumsum([len(x) for x in xs]) for xs in (all_a, all_b))
        a, b = np.concatenate(all_a).astype(np.int64), np.concatenate(all_b).astype(np.int64)
        # The texts follow each other without a gap, so a text's first byte always begins a group.
        length_a, length_b = self.said_a.sizes[a], self.said_b.sizes[b]
        end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
        start_a, start_b = end_a - length_a, end_b - length_b
        group_a, group_b = coalesce(start_a, end_a, start_b, end_b)
        in_a, in_b = overlaps(start_a, end_a, start_b, end_b)
        counts[0, kept], counts[1, kept] = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        counts[2, kept] = np.diff(group_a[ends_a - 1], prepend=-1)
        counts[3, kept] = np.diff(np.searchsorted(in_a, ends_a, "left"), prepend=0)
        # The groups' text: a group's A ids, then its B ids.
        of_a, of_b = np.bincount(group_a), np.bincount(group_b)
        before_b, upto_a = np.cumsum(of_b) - of_b, np.cumsum(of_a)
        said = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        said[np.arange(len(a)) + before_b[group_a]] = 2 * a + last_a
        said[np.arange(len(b)) + upto_a[group_b]] = 2 * (len(self.bytes_a) + b) + last_b
        for i, groups in zip(kept, self.said.joined(np.split(said, (ends_a + ends_b)[:-1]))):
            digests[i] = hashlib.sha256(groups[:-1]).hexdigest()
        return counts, digests, a[in_a] * len(self.bytes_b) + b[in_b]


class _Strings:
    """Byte strings one after the other."""

    def __init__(self, strings: list[bytes]):
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, places: list[np.ndarray]) -> Iterator[memoryview]:
        """The strings at each array of places, joined."""
        if not places:
            return
        flat = np.concatenate(places)
        sizes = self.sizes[flat]
        text = memoryview(stretches(self.bytes, self.starts[flat], sizes).tobytes())
        ends, at = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([len(p) for p in places])].tolist(), 0
        for end in ends:
            yield text[at:end]
            at = end


def _distinct(links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, each link's place among them, and their totals."""
    coded = pa.array(links).dictionary_encode()
    pairs = coded.dictionary.to_numpy()
    order = np.argsort(pairs)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    place = rank[coded.indices.to_numpy()]
    return pairs[order], place, np.bincount(place, minlength=len(order))


def _merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_distinct`` of all links from that of each part."""
    pairs = np.unique(np.concatenate([p for p, _, _ in parts]))
    totals, places = np.zeros(len(pairs), np.int64), []
    for mine, place, times in parts:
        at = np.searchsorted(pairs, mine).astype(np.int32)
        totals[at] += times
        places.append(at[place])
    return pairs, np.concatenate(places), totals


def _give_back() -> None:
    """Free memory goes back to the system, else a worker keeps what its largest batch took beside its JVM's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library
        pass


def _narrow(places: np.ndarray) -> bytes:
    """Places as 2-byte integers where they fit, else as 4-byte ones, after one byte that says which."""
    wide = len(places) > 0 and int(places.max()) >= 1 << 16
    return (b"\4" + places.astype("<u4").tobytes()) if wide else (b"\2" + places.astype("<u2").tobytes())


def _wide(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1)


def _sums(weights: np.ndarray, links: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each row of ``weights`` its sum over the links up to each of ``ends`` from the one before on."""
    upto, before = np.zeros((len(weights), len(ends)), np.int64), np.zeros((len(weights), 1), np.int64)
    for lo in range(0, len(links), SUM_LINKS):
        total = before + np.cumsum(weights[:, links[lo:lo + SUM_LINKS]], axis=1)
        a, b = np.searchsorted(ends, [lo, lo + total.shape[1]], "right")
        upto[:, a:b] = total[:, ends[a:b] - lo - 1]
        before = total[:, -1:]
    return np.diff(upto, axis=1, prepend=0)


def _first(texts: pa.Array | list[str | None], at: int, chars: int) -> list[str | None]:
    """The texts from ``at`` on up to the one that reaches ``chars``."""
    some, held = [], 0
    while at + len(some) < len(texts) and held < chars:
        text = texts[at + len(some)]
        some.append(text.as_py() if isinstance(text, pa.Scalar) else text)
        held += len(some[-1] or "")
    return some


def _aligner(bytes_file: str, pieces_file: str, held: dict = {}) -> Aligner:
    """One pair of tokenizers per worker process."""
    key = (bytes_file, pieces_file)
    if key not in held:
        held[key] = Aligner(*key)
    return held[key]


def aligned_blocks(docs: DataFrame, bytes_file: str, pieces_file: str) -> DataFrame:
    """``BLOCKS`` rows, written once as a table in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(bytes_file, pieces_file)
        number = TaskContext.get().partitionId() << 33
        doc_ids, counts, digests, links, held = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, held
            pairs, place, totals = _merged(links)
            n_a, n_b, n_groups, n_links = np.concatenate(counts, axis=1)
            longs = pa.list_(pa.int64())
            row = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([doc_ids], longs),
                 *(pa.array([c], longs) for c in (n_a, n_b, n_groups, n_links)),
                 pa.array([digests], pa.list_(pa.string())), pa.array([pairs], longs), pa.array([totals], longs),
                 pa.array([_narrow(place)], pa.binary())],
                ["block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "totals", "links"])
            number, held = number + 1, 0
            for part in (doc_ids, counts, digests, links):
                part.clear()
            return row

        for batch in batches:
            ids, texts, encoded = batch.column(0).to_pylist(), batch.column(1), []
            at = 0
            while at < len(ids):
                if not encoded:
                    ready = _first(texts, at, SLICE_CHARS)
                    encoded = aligner.ids_a(ready)
                some = _first(ready, 0, BATCH_CHARS)
                c, d, pairs = aligner.align(some, encoded[:len(some)])
                ready, encoded = ready[len(some):], encoded[len(some):]
                doc_ids.extend(ids[at:at + len(some)])
                counts.append(c)
                digests.extend(d)
                links.append(_distinct(pairs))
                held += len(pairs)
                at += len(some)
                if held >= BLOCK_LINKS:
                    yield block()
                    _give_back()
        if doc_ids:
            yield block()

    spark = docs.sparkSession
    path = shared_path(spark, "aligned_blocks")
    docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, BLOCKS).write.options(**{
            "compression": "zstd", "parquet.block.size": str(GROUP_BYTES), "parquet.block.size.row.check.min": "1",
            "parquet.page.size.row.check.min": "1"}).parquet(path)
    return spark.read.schema(BLOCKS).parquet(path)


def pair_counts(blocks: DataFrame, b_ids: int) -> DataFrame:
    """pair (A id times ``b_ids`` plus B id), links (corpus-wide), best (whether its B id has no higher count)."""
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "totals")).alias("p")).groupBy(
        F.col("p.pairs").alias("pair")).agg(F.sum("p.totals").alias("links"))
    b = F.col("pair") % b_ids
    # One row for each entry of the B vocabulary at most.
    highest = counts.groupBy(b.alias("b")).agg(F.max("links").alias("highest"))
    return counts.join(F.broadcast(highest), b == F.col("b")).select(
        "pair", "links", (F.col("links") == F.col("highest")).alias("best"))


def align_documents(docs: DataFrame, bytes_file: str, pieces_file: str) -> DataFrame:
    """``ALIGNED``: one row per row of ``docs``."""
    blocks = aligned_blocks(docs, bytes_file, pieces_file)
    counts = pair_counts(blocks, _aligner(bytes_file, pieces_file).pieces.vocab_size())
    placed = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    weights = placed.join(counts.hint("shuffle_hash"), "pair").select(
        F.col("block").alias("of"), "place", "links", "best")
    names = [f.split()[0] for f in ALIGNED.split(", ")]

    def add_up(block: pa.Table, weights: pa.Table) -> pa.Table:
        """One block and the weights of its pairs at a time."""
        place, found = weights["place"].to_numpy(), np.zeros((2, weights.num_rows), np.int64)
        found[0, place] = weights["links"].to_numpy()
        found[1, place] = weights["best"].to_numpy()
        rows = []
        for row in block.combine_chunks().to_batches():
            for r in range(row.num_rows):
                doc = {n: row[n][r].values for n in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups")}
                links = np.frombuffer(row["links"][r].as_buffer(), np.uint8)
                sums = _sums(found, _wide(links), np.cumsum(doc["n_links"].to_numpy()))
                rows.append(pa.Table.from_arrays(
                    [doc["doc_ids"], doc["n_a"], doc["n_b"], doc["n_groups"], doc["n_links"],
                     pa.array(sums[1]), pa.array(sums[0]), doc["groups"]], names))
        return pa.concat_tables(rows)

    return blocks.drop("pairs", "totals").groupBy("block").cogroup(weights.groupBy("of")).applyInArrow(add_up, ALIGNED)
