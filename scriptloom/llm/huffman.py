"""Token ids as canonical length-limited Huffman code, in files of independent blocks.

``write_ids`` counts the ids of all documents, makes a code whose words have at most ``MAX_BITS``
bits (package-merge), and writes blocks of whole documents in ascending id order. A code table
lies beside the blocks. ``read_ids`` decodes blocks independently of each other: each block holds
its bits and, for every ``STEP`` ids, the bit offset at which they start, so that all stretches of
a block are decoded side by side by table look-up, and ``read_range`` decodes only the stretches
that a range of positions meets.

File format, under one folder:

- ``code``: Parquet, one row: ``bits`` (length of the code word of each id; 0 if unused).
- ``blocks``: Parquet, one row per block: ``file`` and ``block`` (order), ``in_file`` (ids before it
  in its file), ``n_ids``, ``doc_ids``, ``doc_tokens``, ``offsets`` (bit offsets, one per ``STEP``
  ids), ``payload``.

Tokenising runs once; ids are kept in a stage table as 16 or 32-bit integers. Files are ranges of
doc_id taken from quantiles, so no task sees more than its share; what goes through the driver is
one count per vocabulary entry and one sum per file.

Defined results: null and empty texts hold the end id alone; a null doc_id comes before all others;
rows with the same doc_id follow each other in the order of their ids; an empty table gives an empty
folder of blocks and no rows. Only the two named columns are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from scriptloom.llm.bpe import PLAIN
from scriptloom.session import stage_table

MAX_BITS = 20
HELD_BYTES = 80 << 20  # words and chunks whose ids a worker keeps, twice; smaller tables learn more words again
ENTRY_BYTES = 190  # what an entry takes besides its letters and ids
LONGEST_WORD = 200
# Steps of a normalizer that leave plain words as they are, once in lower case and a blank apart.
NO_CHANGE = (
    {"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
)
STEP = 256
BLOCK_IDS = 1 << 17  # a block is closed by the document that reaches this many ids
BLOCKS = (
    "file int, block int, in_file long, n_ids long, doc_ids array<long>, doc_tokens array<int>, "
    "offsets binary, payload binary"
)


# --- tokenising -------------------------------------------------------------------------------


class LibraryEncoder:
    """Ids of texts by the tokenizers library.

    In a vocabulary with word ends the words of a text do not affect each other. What white space parts
    in plain texts is cut into words; the library is given each different one once, many in one text, and
    its result is cut behind the ids that end a word. Every other text, and every text with a very long
    word, is given to it as a whole.

    Words that were met lately are kept in two tables of ``HELD_BYTES`` each: a full one becomes the
    older one, and what is found there moves back to the newer one.
    """

    def __init__(self, path: str, kind: str = "<u4", held_bytes: int = HELD_BYTES):
        self.library = self.word_library = Tokenizer.from_file(path)
        self.kind = np.dtype(kind)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = [s for s in spec["pre_tokenizer"].get("pretokenizers", []) if s["type"] == "Split"]
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix and split)
        if self.by_word:
            self.words = regex.compile(split[0]["pattern"]["Regex"])
            size = self.library.get_vocab_size()
            self.ends = np.array(
                [(self.library.id_to_token(i) or "").endswith(suffix) for i in range(size)]
            )
            steps = spec.get("normalizer") or {}
            if all(step in NO_CHANGE for step in steps.get("normalizers", [steps])):
                self.word_library = Tokenizer.from_file(path)
                self.word_library.normalizer = normalizers.Sequence([])
        self.held_bytes, self.bytes = held_bytes, 0
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str], library: Tokenizer) -> list[np.ndarray]:
        coded = library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind) for e in coded]

    def _learn(self, chunks: list[str]) -> bool:
        """Put the ids of chunks into the table, and those of the words they consist of.

        Only words that are not in it go to the library, many in one text. False if its result cannot be
        cut between them: then only whole texts are right.
        """
        new = []
        for chunk in chunks:
            ids = self.older.pop(chunk, None)
            if ids is None:
                new.append(chunk)
            else:
                # a copy, so that the memory of the older table is free as a whole when it is dropped
                self.table[chunk] = bytes(memoryview(ids))
                self.bytes += ENTRY_BYTES + 2 * len(chunk) + len(ids)
        for start in range(0, len(new), 2000):
            some = new[start : start + 2000]
            words = self.words.findall(" ".join(some))
            ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64))
            behind = np.cumsum(np.fromiter(map(len, some), dtype=np.int64))
            last = np.searchsorted(ends, behind)  # each chunk's last word
            if last[-1] >= len(words) or (ends[last] != behind).any() or not self._learn_words(words):
                return False
            ids_of, first = self.table, 0
            for chunk, after in zip(some, (last + 1).tolist()):
                if after > first + 1:
                    ids = b"".join([ids_of[w] for w in words[first:after]])
                    ids_of[chunk] = ids
                    self.bytes += ENTRY_BYTES + 2 * len(chunk) + len(ids)
                first = after
        return True

    def _learn_words(self, words: list[str]) -> bool:
        new = list(set(words).difference(self.table))
        if not new:
            return True
        ids = self._ids([" ".join(new)], self.word_library)[0]
        word_ends = np.flatnonzero(self.ends[ids]) + 1
        if len(word_ends) != len(new):
            return False
        raw, cuts = ids.tobytes(), (word_ends * self.kind.itemsize).tolist()
        self.table.update(zip(new, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))
        self.bytes += ENTRY_BYTES * len(new) + 2 * sum(map(len, new)) + len(raw)
        return True

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        if self.bytes > self.held_bytes:
            self.table, self.older, self.bytes = {}, self.table, 0
        rest, open_texts, new = [], [], set()
        look_up = self.table.get
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.by_word and "<|" not in text and PLAIN.fullmatch(text):
                words = text.lower().split()
                found = list(map(look_up, words))
                gaps = [k for k, ids in enumerate(found) if ids is None]
                if not gaps:
                    out[i] = b"".join(found)
                    continue
                missing = [words[k] for k in gaps]
                if max(map(len, missing)) <= LONGEST_WORD:
                    new.update(missing)
                    open_texts.append((i, found, gaps, missing))
                    continue
            rest.append(i)
        if new and not self._learn(list(new)):
            rest += [i for i, *_ in open_texts]
            open_texts = []
        table = self.table
        for i, found, gaps, missing in open_texts:
            for k, word in zip(gaps, missing):
                found[k] = table[word]
            out[i] = b"".join(found)
        if rest:
            for i, ids in zip(rest, self._ids([texts[i] for i in rest], self.library)):
                out[i] = ids.tobytes()
        return out


@lru_cache(maxsize=4)
def library_encoder(path: str, kind: str = "<u4") -> LibraryEncoder:
    return LibraryEncoder(path, kind)


def tokenised(
    docs: DataFrame, path: str, end_id: int, wide: bool, id_column: str, text_column: str
) -> DataFrame:
    """doc_id and ids with the end id, as 16-bit (32-bit if ``wide``) integers."""
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path, kind)
        end = np.array([end_id], dtype=kind).tobytes()
        for batch in batches:
            for start in range(0, len(batch), 128):
                part = batch.slice(start, 128)
                coded = encoder.encode(part.column(1).to_pylist())
                ids = [x + end for x in coded]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) // len(end) for x in ids], pa.int32()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )

    chosen = docs.select(
        docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text")
    )
    return chosen.mapInArrow(run, "doc_id long, n_tokens int, ids binary")


# --- the code ---------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of the best code words of at most ``limit`` bits (package-merge); 0 if unused."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids have no code of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order].astype(np.float64)
    levels, weights = [], coins
    is_coin = np.ones(len(coins), dtype=bool)
    for _ in range(limit):
        levels.append(is_coin)
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((coins, pairs))
        at = np.argsort(both, kind="stable")
        weights, is_coin = both[at], at < len(coins)
    take = 2 * len(coins) - 2
    for level in reversed(levels):
        chosen = int(level[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def code_words(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The canonical code: ids in order of (length, id), and each id's code word."""
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    words = np.zeros(len(lengths), dtype=np.uint64)
    sizes = lengths[order].astype(np.int64)
    # the next code word is the one before plus one, shifted to its own length
    top = int(sizes.max(initial=0))
    steps = np.left_shift(np.int64(1), top - sizes)
    words[order] = ((np.cumsum(steps) - steps) >> (top - sizes)).astype(np.uint64)
    return order, words


class Code:
    """Tables for one set of lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.order, self.words = code_words(lengths)
        self.bits = int(lengths.max(initial=1)) or 1
        sizes = lengths[self.order].astype(np.int64)
        spans = np.left_shift(np.int64(1), self.bits - sizes)
        self.symbol = np.repeat(self.order.astype(np.uint32), spans)
        self.size = np.repeat(sizes.astype(np.uint8), spans)
        missing = (1 << self.bits) - len(self.symbol)
        if missing:  # a code of one word leaves half of the table unused
            self.symbol = np.append(self.symbol, np.zeros(missing, np.uint32))
            self.size = np.append(self.size, np.ones(missing, np.uint8))

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Bit offsets of every STEP-th id, and the bits, first bit highest."""
        sizes = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        total = int(ends[-1]) if len(ids) else 0
        at = starts >> 5
        shift = (64 - sizes - (starts & 31)).astype(np.uint64)
        window = self.words[ids] << shift
        # Code words do not overlap, so sums are unions; 32 bits are exact in a double.
        n = (total >> 5) + 2
        out = np.bincount(at, weights=(window >> np.uint64(32)).astype(np.float64), minlength=n)
        out[: n] += np.bincount(
            at + 1, weights=(window & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n
        )[:n]
        payload = out.astype(">u4").tobytes()[: (total + 7) >> 3]
        return starts[::STEP], payload

    def decode(self, offsets: np.ndarray, payload: bytes, n_ids: int) -> np.ndarray:
        """The ids of stretches that start at the offsets: STEP each, the last one the rest."""
        lanes = len(offsets)
        if not lanes:
            return np.zeros(0, dtype=np.uint32)
        out = np.zeros((lanes, STEP), dtype=np.uint32)
        raw = np.frombuffer(payload + bytes(8), dtype=np.uint8).astype(np.uint32)
        # 32 bits from every byte on
        view = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at = offsets.astype(np.int64)
        down = np.uint32(32 - self.bits)
        last = n_ids - (lanes - 1) * STEP
        for k in range(STEP):
            if k == last:  # the last stretch has ended
                at = at[:-1]
                if not len(at):
                    break
            peek = (view[at >> 3] << (at & 7).astype(np.uint32)) >> down
            out[: len(at), k] = self.symbol[peek]
            at = at + self.size[peek]
        return out.reshape(-1)[:n_ids]


# --- writing and reading ----------------------------------------------------------------------


def global_counts(stage: DataFrame, vocabulary: int, wide: bool) -> np.ndarray:
    """How often each id occurs, summed in the tasks first; at most one row per id comes back."""
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            joined = b"".join(x.as_py() for x in batch.column(0))
            counts += np.bincount(np.frombuffer(joined, dtype=kind), minlength=vocabulary)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["id", "n"]
        )

    rows = (
        stage.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ).collect()
    counts = np.zeros(vocabulary, dtype=np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return counts


def write_ids(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int,
    id_column: str = "doc_id", text_column: str = "text", files: int | None = None,
) -> None:
    """Encode all texts and write them under ``folder``, which all executors share."""
    spark = docs.sparkSession
    vocabulary = 1 + max(
        end_id, *Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values()
    )
    wide = vocabulary > 1 << 16
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stage = stage_table(tokenised(docs, tokenizer_path, end_id, wide, id_column, text_column))
    lengths = code_lengths(global_counts(stage, vocabulary, wide))
    spark.createDataFrame([(lengths.tobytes(),)], "bits binary").coalesce(1).write.parquet(
        f"{folder}/code"
    )
    cuts = stage.select(
        F.percentile_approx(
            "doc_id", [i / files for i in range(1, files)] or [0.5], 20 * files
        ).alias("cuts")
    ).first()["cuts"]
    bounds = sorted(set(cuts or []))
    # the number of bounds at or below the doc_id
    place = F.coalesce(
        F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("doc_id"))), F.lit(0)
    ) if bounds else F.lit(0)
    kind = "<u4" if wide else "<u2"
    bits = spark.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(bits.value)
        file, block, before, doc_ids, ids = None, 0, 0, [], []

        def close() -> pa.RecordBatch:
            joined = np.concatenate(ids)
            offsets, payload = code.encode(joined)
            row = (file, block, before, len(joined), list(doc_ids), [len(x) for x in ids],
                   offsets.astype("<i8").tobytes(), payload)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                     pa.binary(), pa.binary())
            names = [x.split()[0] for x in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds)], names=names
            )

        held = 0
        for batch in batches:
            for where, doc, raw in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            ):
                if ids and (where != file or held >= BLOCK_IDS):
                    yield close()
                    block, before, doc_ids, ids, held = block + 1, before + held, [], [], 0
                if where != file:
                    file, block, before = where, 0, 0
                doc_ids.append(doc)
                ids.append(np.frombuffer(raw.as_py(), dtype=kind))
                held += len(ids[-1])
        if ids:
            yield close()

    (
        stage.select(place.cast("int").alias("file"), "doc_id", "ids")
        .repartitionById(len(bounds) + 1, F.col("file"))
        .sortWithinPartitions("file", F.col("doc_id").asc_nulls_first(), "ids")
        .mapInArrow(run, BLOCKS)
        .write.option("compression", "none")
        .parquet(f"{folder}/blocks")
    )


def stored_code(spark: SparkSession, folder: str) -> np.ndarray:
    return np.frombuffer(spark.read.parquet(f"{folder}/code").first()["bits"], dtype=np.uint8)


def blocks_with_start(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks with ``start``, the number of ids before each. One row per file is broadcast."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    sums = blocks.groupBy("file").agg(F.sum("n_ids").alias("n")).collect()
    starts, total = [(-1, 0)], 0
    for row in sorted(sums, key=lambda r: r["file"]):
        starts.append((row["file"], total))
        total += row["n"]
    files = spark.createDataFrame(starts, "file int, file_start long")
    return blocks.join(F.broadcast(files), "file").withColumn(
        "start", F.col("file_start") + F.col("in_file")
    )


def read_ids(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """Per document its doc_id, the ids before it, and its ids (or their number and CRC32)."""
    bits = spark.sparkContext.broadcast(stored_code(spark, folder))
    schema = "doc_id long, start long, " + (
        "n_tokens long, ids_crc32 long" if digests else "ids array<int>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(bits.value)
        for batch in batches:
            for row in range(len(batch)):
                n_ids, doc_ids, sizes, offsets, payload, start = (
                    batch.column(c)[row] for c in range(6)
                )
                ids = code.decode(
                    np.frombuffer(offsets.as_py(), dtype="<i8"), payload.as_py(), n_ids.as_py()
                ).astype("<u4")
                sizes = np.array(sizes.as_py(), dtype=np.int64)
                ends = np.cumsum(sizes)
                columns = [
                    pa.array(doc_ids.as_py(), pa.int64()),
                    pa.array(start.as_py() + ends - sizes, pa.int64()),
                ]
                if digests:
                    raw = memoryview(ids.tobytes())
                    crc = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for e, s in zip(ends, sizes)]
                    columns += [pa.array(sizes), pa.array(crc, pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                else:
                    columns.append(
                        pa.array([ids[e - s : e].astype(np.int32) for e, s in zip(ends, sizes)],
                                 pa.list_(pa.int32()))
                    )
                    names = ["doc_id", "start", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return (
        blocks_with_start(spark, folder)
        .select("n_ids", "doc_ids", "doc_tokens", "offsets", "payload", "start")
        .mapInArrow(run, schema)
    )


def read_range(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """The ids at positions ``first`` up to ``last`` (left out): start, ids for each block's part.

    Only the blocks that meet the range are read, and in them only the stretches that meet it.
    """
    bits = spark.sparkContext.broadcast(stored_code(spark, folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(bits.value)
        for batch in batches:
            for row in range(len(batch)):
                n_ids, raw, payload, start = (batch.column(c)[row].as_py() for c in range(4))
                offsets = np.frombuffer(raw, dtype="<i8")
                low, high = max(first - start, 0), min(last - start, n_ids)
                a, b = low // STEP, (high + STEP - 1) // STEP
                ids = code.decode(offsets[a:b], payload, min(n_ids, b * STEP) - a * STEP)
                part = ids[low - a * STEP : high - a * STEP].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([start + low], pa.int64()), pa.array([part], pa.list_(pa.int32()))],
                    names=["start", "ids"],
                )

    meets = (F.col("start") < last) & (F.col("start") + F.col("n_ids") > first)
    return (
        blocks_with_start(spark, folder)
        .where(meets)
        .select("n_ids", "offsets", "payload", "start")
        .mapInArrow(run, "start long, ids array<int>")
    )

