"""Token counts by scanning flat token files for the end-of-document identifier.

The files hold token identifiers of fixed width and nothing else: no index, no lengths. They are cut into blocks of fixed
size wherever these fall. Each block is searched in one vectorised pass; what a block cannot know (where the document that
reaches into it began, and how many ended before) comes from a prefix scan over one row per block.

Defined results: a null or empty text has no tokens. Rows are counted one by one, so null or repeated ids change nothing, and texts are of any length.
An empty table gives an empty result. Tokens after a file's last identifier are a document without an end and are
reported as such. Text that spells a special token is ordinary text. Other columns of the input are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchantlake.llm.common import batches_of_bytes, new_path, partitions, store
from merchantlake.llm.remote import locate

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The identifier that the vocabulary leaves free for ends of documents, and its pattern of pre-tokens.
END_OF_DOCUMENT = 50256
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space from which on the pattern is not asked.
LONG_SPACE = re.compile(f"[{SPACES}]{{1000,}}")
WIDTH = np.dtype("<u2")
BLOCK_TOKENS = 1 << 20
TEXT_AT_ONCE = 1 << 22


@lru_cache(maxsize=1)
def _encoder(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("documents", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(encoder, text: str) -> list[int]:
    """As the encoder gives them, also for white space too long for its pattern.

    A run of white space is a pre-token of its own but for its last character, which goes with what follows; at the end of a text it
    is one as a whole. So a text can be cut there, and the run be merged without the pattern.
    """
    ids, begin = [], 0
    for run in LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoder.encode_ordinary(text[begin : run.start()])
        ids += encoder._encode_single_piece(text[run.start() : end])
        begin = end
    return ids + encoder.encode_ordinary(text[begin:] if begin else text)


def _write(folder: str, vocabulary: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, inside = locate(f"{folder}/{uuid4().hex}.bin")
        system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
        encoder, ordinal = None, 0
        with system.open_output_stream(inside) as out:
            for batch in batches:
                encoder = encoder or _encoder(vocabulary)
                texts = batch["text"].tolist()
                for begin, end in batches_of_bytes(texts, TEXT_AT_ONCE):
                    for text in texts[begin:end]:
                        out.write(np.array([*token_ids(encoder, text or ""), END_OF_DOCUMENT], dtype=WIDTH).tobytes())
                numbers = np.arange(ordinal, ordinal + len(batch))
                ordinal += len(batch)
                yield pd.DataFrame({"file": inside.rsplit("/", 1)[1], "ordinal": numbers, "doc_id": batch["doc_id"]})

    return run


def write_token_files(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> tuple[str, DataFrame]:
    """A folder of flat token files, one per task, and (file, ordinal, doc_id): which document comes where.

    A task that is run again writes another file. Only files that the stored table names are part of the result.
    """
    folder = new_path(docs.sparkSession, "tokens")
    given = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    order = given.mapInPandas(_write(folder, vocabulary), "file string, ordinal bigint, doc_id string")
    return folder, store(order.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType)), "token-order")


def _sizes(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [locate(f"{folder}/{name}") for name in batch["file"]]
            yield pd.DataFrame({"file": batch["file"], "tokens": [s.get_file_info(p).size // WIDTH.itemsize for s, p in found]})

    return run


def _search(folder: str, separator: int, block: int):
    """Per block: how many separators, where in the file the last is, and the distances from one to the next.

    The first distance is taken from the block's own begin; the scan over blocks mends it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, begin, end in zip(batch["file"], batch["begin"], batch["end"]):
                system, inside = locate(f"{folder}/{name}")
                with system.open_input_file(inside) as source:
                    raw = source.read_at((end - begin) * WIDTH.itemsize, begin * WIDTH.itemsize)
                ends = begin + np.flatnonzero(np.frombuffer(raw, dtype=WIDTH) == separator)
                lengths = np.diff(ends, prepend=begin - 1) - 1
                yield pd.DataFrame({
                    "file": [name], "begin": [begin], "end": [end], "n": [len(ends)],
                    "last": [ends[-1] if len(ends) else -1], "lengths": [lengths],
                })

    return run


def scan_token_files(folder: str, files: DataFrame, separator: int = END_OF_DOCUMENT, block: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, n_tokens, ended) of every document in the flat files named by ``files`` (file)."""
    spark = files.sparkSession
    sized = files.select("file").distinct().mapInPandas(_sizes(folder), "file string, tokens bigint")
    begins = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tokens") - 1, F.lit(block).cast("bigint"))).alias("begin")
    blocks = sized.where("tokens > 0").select("file", "tokens", begins)
    blocks = blocks.select("file", "begin", F.least(F.col("begin") + block, F.col("tokens")).alias("end"))
    searched = store(
        blocks.repartition(partitions(spark), "file", "begin").mapInPandas(
            _search(folder, separator, block), "file string, begin bigint, end bigint, n bigint, last bigint, lengths array<bigint>"
        ),
        "token-blocks",
    )
    # The prefix scan: documents that ended in earlier blocks of the file, and where the last of them ended.
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    carried = searched.select(
        "file", "begin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("previous"),
    )
    stitched = searched.join(carried, ["file", "begin"]).select(
        "file", "begin", "earlier", "previous", F.posexplode("lengths").alias("k", "length")
    )
    reached_in = F.when(F.col("k") == 0, F.col("begin") - F.col("previous") - 1).otherwise(F.lit(0))
    ended = stitched.select(
        "file", (F.col("earlier") + F.col("k")).alias("ordinal"), (F.col("length") + reached_in).alias("n_tokens"), F.lit(True).alias("ended")
    )
    totals = searched.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.max("end") - F.max("last") - 1).alias("n_tokens"))
    return ended.unionByName(totals.where("n_tokens > 0").withColumn("ended", F.lit(False)))


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens (without the end-of-document identifier) of every row of ``docs``."""
    folder, order = write_token_files(docs, doc_id, text, vocabulary)
    counts = scan_token_files(folder, order.select("file"))
    return order.join(counts, ["file", "ordinal"], "left").select("doc_id", "n_tokens")
