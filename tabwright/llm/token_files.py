"""Token ids in compressed files, in rising order of the documents' ids.

Texts are encoded with a ready tokenizer, an end id is appended to each, and the
ids of consecutive documents go to file images (``id_coder``), which Spark writes
as rows of a table in the folder: part, number within the part, and the image.
Spark's committer makes the write safe against lost executors.

Defined cases: a null text is empty and has the end id only; null ids come first;
rows that share an id are ordered by text.  An empty table gives an empty result.
Ids come back with the type they had.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabwright.llm.common import mapped, shared_folder, staged
from tabwright.llm.id_coder import Image, write_image
from tabwright.llm.word_arrays import bytes_and_ends, cut, different, joined, slices

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
# An image ends with the document that brings it to this many ids.
IMAGE_IDS = 1 << 23
UNITS, UNIT_CHARS = 1_000_000, 48
PAIR_OF_BLANKS = re.compile(r"\s\s")
# Bytes that a blank may end or begin with: the ASCII ones, and the last and first bytes of longer characters.
ASCII_BLANKS = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
MAY_END_BLANK = ASCII_BLANKS | (np.arange(256) >= 0x80)
MAY_BEGIN_BLANK = ASCII_BLANKS | np.isin(np.arange(256), [*{chr(code).encode()[0] for code in range(128, 0x10000) if chr(code).isspace()}])


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary uses for each byte: itself where it prints, else one from U+0100 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte) if byte in prints else chr(next(others)) for byte in range(256)]


class _Units(dict):
    """Ids of short units by their bytes: what stands before the first break of a text, or a break with what follows it."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.letters = tokenizer, tokenizer.model, byte_letters()
        self.lead = {"": "", " ": self.letters[32]}

    def __missing__(self, unit: bytes) -> bytes:
        text = unit.decode()
        lead = text[:1] if text[:1] in (" ", "\n") else ""
        word = text[len(lead) :]
        stem = word.rstrip(punctuation)
        if lead == "\n" and word:
            # The tokenizer splits behind a line break that stands before a word.
            ids = self[b"\n"] + self[unit[1:]]
        elif not stem.isalpha():
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        elif len(stem) < len(word):
            # After letters, marks up to the unit's end are a run of their own.
            ids = self[(lead + stem).encode()] + self[word[len(stem) :].encode()]
        else:
            # Letters are one run of the tokenizer's splitting, so its model alone decides.
            letters = self.lead[lead] + word if word.isascii() else "".join(map(self.letters.__getitem__, unit))
            ids = array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()
        if len(text) - len(lead) <= UNIT_CHARS:
            if len(self) >= UNITS:
                self.clear()
            self[unit] = ids
        return ids


class TextEncoder:
    """Ids of whole texts; what stands between single spaces and line breaks is remembered.

    The tokenizer's own splitting breaks at a space or line break between two
    other characters and puts the space before the next word, so these stretches
    can be encoded one by one.  Texts with two blanks in a row go to it whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.units = _Units(self.tokenizer)

    def _with_pairs(self, texts: pa.Array) -> list[int]:
        """Places of texts with two blanks in a row."""
        data, ends = bytes_and_ends(texts)
        data = np.frombuffer(data, np.uint8)
        near = np.flatnonzero(MAY_END_BLANK.take(data[:-1]) & MAY_BEGIN_BLANK.take(data[1:]))
        places = np.unique(np.searchsorted(ends, near, side="right") - 1).tolist()
        return [place for place in places if PAIR_OF_BLANKS.search(texts[place].as_py() or "")]

    def ids_of_all(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, an end id after each, and how many each has; each different unit is looked up once."""
        whole = self._with_pairs(texts)
        parts = [array("I", self.tokenizer.encode(texts[place].as_py(), add_special_tokens=False).ids).tobytes() for place in whole]
        if whole:
            apart = np.zeros(len(texts), bool)
            apart[whole] = True
            texts = pc.if_else(pa.array(apart), pa.scalar("", texts.type), texts)
        data, ends = bytes_and_ends(texts)
        data = np.frombuffer(data, np.uint8)
        breaks = np.flatnonzero((data == 32) | (data == 10))
        # A unit begins with each text, too, so that each has one, if only of no bytes.
        numbers, units = different(cut(data, np.sort(np.concatenate((breaks, ends[:-1])))))
        found = [*map(self.units.__getitem__, units), *parts, end_id.to_bytes(4, "little")]
        last = np.searchsorted(breaks, ends[1:]) + np.arange(1, len(ends))
        numbers = numbers.astype(np.int64)
        numbers[last[whole] - 1] = len(units) + np.arange(len(whole))
        ids, own = joined(found, np.insert(numbers, last, len(found) - 1), 4)
        return ids, np.diff(np.cumsum(own)[last + np.arange(len(last))], prepend=0)

    def ids_of(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit integers."""
        return self.ids_of_all(pa.array([text], pa.string()), END_ID)[0][:-1].tobytes()


@lru_cache(maxsize=1)
def text_encoder(path: str) -> TextEncoder:
    """One encoder per Python worker and file."""
    return TextEncoder(path)


def write_token_files(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
                      tokenizer: str = TOKENIZER, end_id: int = END_ID, image_ids: int = IMAGE_IDS) -> None:
    """Write all documents in rising order of their key; texts are shuffled once, by range."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    ranged = rows.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
    ranged = ranged.select(F.spark_partition_id().alias("part"), F.col("key").cast("string").alias("key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer)
        names, sizes, held, part, number, total = [], [], [], 0, 0, 0

        def image() -> pa.RecordBatch:
            ids = np.concatenate(held).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([write_image(names, sizes, ids)], pa.binary())],
                ["part", "number", "image"])

        for batch in batches:
            for rows in slices(batch, "text"):
                part = rows.column("part")[0].as_py()
                ids, counts = encoder.ids_of_all(rows.column("text"), end_id)
                keys, ends, first = rows.column("key").to_pylist(), np.cumsum(counts), 0
                while first < len(keys):
                    before = int(ends[first - 1]) if first else 0
                    last = min(int(np.searchsorted(ends, before + image_ids - total)) + 1, len(keys))
                    names += keys[first:last]
                    sizes += counts[first:last].tolist()
                    held.append(ids[before : ends[last - 1]])
                    total += len(held[-1])
                    first = last
                    if total >= image_ids:
                        yield image()
                        names, sizes, held, total, number = [], [], [], 0, number + 1
        if names:
            yield image()

    # Images are compressed already.
    mapped(ranged, run, "part int, number int, image binary").write.option("compression", "uncompressed").parquet(folder)


def read_token_files(spark: SparkSession, folder: str, key_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and on demand the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(*[column.to_pylist() for column in batch.columns]):
                image = Image(data)
                coded = image.ids().astype("<u4")
                ends = np.cumsum(image.sizes)
                starts = ends - image.sizes
                checks = [zlib.crc32(coded[start:end].tobytes()) for start, end in zip(starts.tolist(), ends.tolist())]
                arrays = [pa.array([part] * len(ends), pa.int32()), pa.array([number] * len(ends), pa.int32()),
                          pa.array(image.names, pa.string()), pa.array(starts), pa.array(image.sizes), pa.array(checks, pa.int64())]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.append(starts, len(coded)).astype(np.int32)), pa.array(coded.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, ["part", "number", "name", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])])

    images = spark.read.schema("part int, number int, image binary").parquet(folder).select("part", "number", "image")
    schema = "part int, number int, name string, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    found = mapped(images, run, schema)
    return found.withColumn("doc_id", F.col("name").cast(key_type))


def token_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None, tokenizer: str = TOKENIZER,
               end_id: int = END_ID, image_ids: int = IMAGE_IDS) -> DataFrame:
    """Write the files, read them back, and return key, start, n_tokens and ids_crc32 of each document.

    ``start`` adds what earlier parts and earlier images of the part hold: one
    row per part passes an unpartitioned window.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write_token_files(docs, folder, key, text, tokenizer, end_id, image_ids)
    rows = read_token_files(spark, folder, docs.schema[key].dataType.simpleString())
    rows = staged(rows)
    images = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("ids"))
    parts = images.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = lambda window: F.coalesce(F.sum("ids").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part_starts = parts.select("part", before(Window.orderBy("part")).alias("part_start"))
    image_starts = images.select("part", "number", before(Window.partitionBy("part").orderBy("number")).alias("image_start"))
    starts = image_starts.join(part_starts, "part").select("part", "number", (F.col("image_start") + F.col("part_start")).alias("base"))
    return rows.join(starts, ["part", "number"]).select(
        F.col("doc_id").alias(key), (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
