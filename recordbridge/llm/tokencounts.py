"""Token counts of flat, unindexed token files by a scan for separators.

A token file is a row of little-endian ids of fixed width in which an end-of-document id closes each
document. Its blocks are scanned in parallel by one vectorised comparison each; a block reports the
counts of the documents that lie wholly inside it and the tokens before its first and behind its
last separator. A prefix sum over the (short) block reports of a file then numbers the documents and
joins what crosses block boundaries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from . import texts

END = 65535  # end-of-document id of 16-bit files


def read_files(spark: SparkSession, path: str, block_bytes: int = 1 << 20) -> DataFrame:
    """(file, block, ids): the blocks of flat token files. ``block_bytes`` is a multiple of the id's width.

    Spark reads a file of this kind as one cell, so a file must be smaller than 2 GB.
    """
    raw = spark.read.format("binaryFile").load(path)
    begins = F.sequence(F.lit(0), F.greatest(F.length("content") - 1, F.lit(0)), F.lit(block_bytes))
    rows = raw.select(F.col("path").alias("file"), "content", F.posexplode(begins).alias("block", "begin"))
    return rows.select("file", F.col("block").cast("bigint").alias("block"), F.expr(f"substring(content, begin + 1, {block_bytes})").alias("ids"))


def count(blocks: DataFrame, end: int = END, width: int = 2) -> DataFrame:
    """(file, document, n_tokens) with documents numbered from 0 in file order; separators are not counted.

    ``blocks`` has file, block (its order in the file) and ids (bytes). Tokens behind the last
    separator of a file are a document of their own. Null ids are no tokens; an empty file has no
    document. A block repeated in a file is an error of the input and is counted as often as it occurs.
    """
    kind = np.dtype(f"<u{width}")

    def scan(batches):
        for batch in batches:
            inner, seps, heads, tails = [], [], [], []
            for cell in batch.column("ids"):
                ids = np.frombuffer(cell.as_py() or b"", kind)
                at = np.flatnonzero(ids == end)
                inner.append(np.diff(at) - 1)
                seps.append(len(at))
                heads.append(int(at[0]) if len(at) else len(ids))
                tails.append(len(ids) - 1 - int(at[-1]) if len(at) else 0)
            yield texts.with_columns(batch.select(["file", "block"]), inner=pa.array(inner, pa.list_(pa.int64())), seps=pa.array(seps, pa.int64()), head=pa.array(heads, pa.int64()), tail=pa.array(tails, pa.int64()))
        texts.release()

    # Every block's report is used twice: for the prefix sum without and for the documents with its counts.
    reports = materialise(blocks.select("file", "block", "ids").mapInArrow(scan, "file string, block bigint, inner array<bigint>, seps bigint, head bigint, tail bigint"), "token-blocks")
    # Runs of blocks: one begins behind every block that has a separator.
    runs = reports.select("file", "block", "seps", "head", "tail").selectExpr(
        "*", "coalesce(sum(seps) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
        "count_if(seps > 0) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run",
        "max(block) OVER (PARTITION BY file) = block AS is_last",
    )
    # What a separator closes: the tail of the block that began the run and all heads of the run.
    pieces = runs.selectExpr("file", "inline(array(struct(run, before AS document, head AS n, seps > 0 OR (is_last AND head > 0) AS closes), struct(run + 1 AS run, before + seps AS document, tail AS n, seps > 0 AND is_last AND tail > 0 AS closes)))")
    joined = pieces.groupBy("file", "run").agg(F.max("document").alias("document"), F.sum("n").alias("n_tokens"), F.bool_or("closes").alias("closes"))
    open_tail = runs.where("is_last AND seps = 0").select("file", F.col("run").alias("last_run"))
    joined = joined.join(open_tail, "file", "left").where("closes OR (run = last_run AND n_tokens > 0)")
    numbered = reports.select("file", "block", "inner").join(runs.select("file", "block", "before"), ["file", "block"])
    inside = numbered.select("file", F.posexplode("inner").alias("i", "n_tokens"), "before").select("file", (F.col("before") + F.col("i") + 1).alias("document"), "n_tokens")
    return joined.select("file", "document", "n_tokens").unionByName(inside)


def word_files(df: DataFrame, text: str, key: str, block_bytes: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """Token files made of a table, one for each of its partitions: blocks, and (file, document, key).

    Ids are words hashed to 16 bits below ``END``; every text, also a null or empty one, is closed by
    ``END``. Both tables are written to the shared folder first, so numbers stay what they are if
    tasks are run again.
    """

    def write(batches):
        from pyspark import TaskContext

        name, rest, block, document = f"part-{TaskContext.get().partitionId():06d}", b"", 0, 0
        row = lambda **x: pa.record_batch({"file": pa.array([name] * len(x["block"]), pa.string()), "block": pa.array(x["block"], pa.int64()), "ids": pa.array(x["ids"], pa.binary()), "document": pa.array(x["document"], pa.int64()), "key": pa.array(x["key"], pa.int64())})
        for batch in batches:
            for part in texts.slices(batch, text):
                found = texts.words(*texts.flat(part.column(text)))
                ids = (found.hashes % np.uint64(END)).astype("<u2")
                rest += np.insert(ids, found.bounds[1:], np.array(END, "<u2")).tobytes()
                n = part.num_rows
                yield row(block=[None] * n, ids=[None] * n, document=range(document, document + n), key=part.column(key))
                document += n
                cut = len(rest) // block_bytes * block_bytes
                full = [rest[i : i + block_bytes] for i in range(0, cut, block_bytes)]
                yield row(block=range(block, block + len(full)), ids=full, document=[None] * len(full), key=[None] * len(full))
                block, rest = block + len(full), rest[cut:]
        if rest:
            yield row(block=[block], ids=[rest], document=[None], key=[None])
        texts.release()

    made = df.select(text, F.col(key).cast("bigint").alias(key)).mapInArrow(write, "file string, block bigint, ids binary, document bigint, key bigint")
    made = materialise(made, "token-files")
    return made.where("block IS NOT NULL").select("file", "block", "ids"), made.where("document IS NOT NULL").select("file", "document", F.col("key").alias(key))
