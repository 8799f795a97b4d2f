"""Token counts of documents in flat token files, by a scan for separators.

A token file is little-endian identifiers behind each other, 2 bytes each, with an
end-of-document identifier after every document, and nothing that says where one
begins. The scan cuts files into blocks, searches each for the identifier at once,
and stitches documents that cross blocks by a prefix scan over the blocks' summaries.

A null or empty text is a document of 0 tokens. Tokens after a file's last separator
are an unterminated document; an empty file has none. Rows that repeat are counted
each. One file must fit into memory (Spark reads it whole); blocks bound the rest. So the
writer begins another file every `FILE_BYTES`; the files of a partition are one run of
tokens, and `joined` lets the prefix scan go on from one to the next.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WIDTH = 2
BLOCK_BYTES = 1 << 20
#: Bytes of a written file, or one longer document.
FILE_BYTES = 16 << 20
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END_OF_DOCUMENT = 50_256
# Fixed value: the pattern by which byte-level BPE of this kind cuts text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    end: int = END_OF_DOCUMENT,
    text_col: str = "text",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Tokenise and write flat files, at least one per partition, of `file_bytes` or one longer document.

    The text sink writes rows as they are and the separator after each, here the bytes
    of the end-of-document identifier; so Spark commits the files like any table. A row
    holds the documents of a file, with that identifier between them.
    """
    mark = end.to_bytes(WIDTH, "little")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(parts: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([mark.join(parts)], pa.binary())], names=["value"])

        encode, waiting, held = None, [], 0
        for batch in batches:
            encode = encode or encoder(vocabulary).encode_ordinary
            for text in batch.column(0):
                tokens = np.array(encode(text.as_py() or ""), "<u2").tobytes()
                if waiting and held + len(tokens) + WIDTH > file_bytes:
                    yield row(waiting)
                    waiting, held = [], 0
                waiting.append(tokens)
                held += len(tokens) + WIDTH
        if waiting:
            yield row(waiting)

    rows = docs.select(text_col).mapInArrow(tokenise, "value binary").select(F.col("value").cast("string"))
    writer = rows.write.option("lineSep", mark.decode("iso-8859-1")).option("encoding", "ISO-8859-1")
    writer.option("maxRecordsPerFile", 1).text(path)


def read_blocks(spark: SparkSession, path: str, block: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, bytes) of flat files; `block` is a multiple of the width of a token."""
    if block % WIDTH:
        raise ValueError("A block must hold whole tokens")
    files = spark.read.format("binaryFile").load(path).filter("length > 0")
    cuts = F.transform(
        F.sequence(F.lit(0), ((F.col("length") - 1) / block).cast("int")),
        lambda i: F.substring("content", i * block + 1, F.lit(block)),
    )
    return files.select("path", cuts.alias("cuts")).select(
        F.col("path").alias("file"), F.posexplode("cuts").alias("block", "bytes")
    )


def scan(blocks: DataFrame, end: int = END_OF_DOCUMENT) -> DataFrame:
    """Summary of each block: tokens before its first separator, between, and after the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails, inner, ends = [], [], [], []
            for raw in batch.column(2):
                tokens = np.frombuffer(raw.as_buffer(), "<u2")
                at = np.flatnonzero(tokens == end)
                heads.append(int(at[0]) if len(at) else len(tokens))
                tails.append(len(tokens) - int(at[-1]) - 1 if len(at) else len(tokens))
                inner.append(np.diff(at) - 1)
                ends.append(len(at))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(heads, pa.int64()), pa.array(tails, pa.int64()), pa.array(inner, pa.list_(pa.int64())), pa.array(ends, pa.int64())],
                names=["file", "block", "head", "tail", "inner", "ends"],
            )

    return blocks.mapInArrow(run, "file string, block int, head long, tail long, inner array<long>, ends long")


def joined(summaries: DataFrame) -> DataFrame:
    """Summaries with a partition's number for the file, and a block's place in all its files."""
    name = F.regexp_extract("file", "[^/]*$", 0)
    nth = F.regexp_extract(name, "-c([0-9]+)[^-]*$", 1).cast("int")
    part = F.regexp_extract(name, "part-([0-9]+)", 1).cast("int")
    return summaries.withColumns({"file": part, "block": F.struct(nth.alias("nth"), F.col("block").alias("block"))})


def count_tokens(summaries: DataFrame) -> DataFrame:
    """(file, position, n_tokens, terminated) of every document, stitched across a file's blocks in their order."""
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    # What is open before a block: all tails since the last block with a separator.
    opened = F.coalesce(F.sum("tail").over(earlier), F.lit(0))
    stitched = (
        summaries.withColumn("opened", opened)
        .withColumn("mark", F.when(F.col("ends") > 0, F.col("opened")))
        .withColumn("since", F.coalesce(F.last("mark", ignorenulls=True).over(earlier), F.lit(0)))
        .withColumn("before", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
        .withColumn("last", F.lead("block").over(order).isNull())
    )
    carried = F.col("opened") - F.col("since")
    closed = F.when(F.col("ends") > 0, F.concat(F.array(carried + F.col("head")), "inner")).otherwise(F.array().cast("array<long>"))
    documents = stitched.select("file", "before", F.posexplode(closed).alias("nth", "n_tokens"))
    whole = documents.select("file", (F.col("before") + F.col("nth")).alias("position"), "n_tokens", F.lit(True).alias("terminated"))
    left = F.when(F.col("ends") > 0, F.col("tail")).otherwise(carried + F.col("tail"))
    rest = stitched.filter("last").select("file", (F.col("before") + F.col("ends")).alias("position"), left.alias("n_tokens"), F.lit(False).alias("terminated"))
    return whole.unionByName(rest.filter("n_tokens > 0"))
