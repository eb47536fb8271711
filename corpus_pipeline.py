"""Training-corpus pipeline over ``documents``: five stages, each an operator of ``microtally.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read
again as the documents of the next. All but the last return the columns of ``docs``; the last returns
the tokens of the training order.

The order of the mix is that of the written files: stage four sorts its rows, Spark numbers the files
by range, and rows stand in a file as sorted. Readers deal files and parts of files to tasks by size, so
the last stage says of each row where it stood: sorted by ``shard, block, row`` its rows are the training
order. A frame that was not read from files stands in its own order.

Nulls, empty texts, ties, repeated rows and empty tables are treated by each stage as the operator it
calls says. Rows with null scores do not occur: every text gets a score.
"""

from pyspark.sql import functions as F

from microtally.llm import byte_bpe, mixing, quality_classifier, quality_rules, simhash
from microtally.llm.registry import query, read
from microtally.session import scratch_path


def keep_good(spark, docs, sf_dir):
    """Documents to which the classifier gives a good chance of being good; the others go."""
    net = quality_classifier.train(docs, read(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, net, into="pipeline$score")
    return scored.filter(F.col("pipeline$score") >= quality_classifier.THRESHOLD).drop("pipeline$score")


def keep_by_rules(spark, docs, sf_dir):
    """Documents that no quality rule rejects."""
    judged = quality_rules.quality_cascade(docs, into="pipeline$rules")
    return judged.filter("`pipeline$rules`.kept").drop("pipeline$rules")


def keep_one_of_each(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return simhash.one_of_each_group(docs)


def mix(spark, docs, sf_dir):
    """The documents in training order, whole; a document that is used twice is there twice."""
    return mixing.mixed_documents(docs)


def encode(spark, docs, sf_dir):
    """Token ids of each document, with the digest of what they decode to and the place in the training order."""
    shard = F.regexp_extract(F.input_file_name(), r"part-(\d+)[^/]*$", 1).try_cast("long")
    places = [shard.alias("shard"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("row")]
    tokens = byte_bpe.tokenize(docs.select("doc_id", "lang", "source", "text", *places), digests=True)
    return tokens.select("shard", "block", "row", "doc_id", "lang", "source", F.size("tokens.ids").cast("long").alias("n_tokens"), "tokens.ids", "tokens.decoded_sha256")


STAGES = [
    ("quality classifier", keep_good),
    ("quality rules", keep_by_rules),
    ("simhash near-duplicates", keep_one_of_each),
    ("mixing to target weights", mix),
    ("byte-level bpe", encode),
]

# The network, the fingerprints' components and the merges are beyond SQL.
ORACLE_SQL = None


@query("pipeline")
def run(spark, sf_dir):
    """The stages one after the other, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
