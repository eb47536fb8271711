"""Bounded samples of labelled documents, for fitting a model on the driver."""

from pyspark.sql import functions as F

from microtally.session import checkpointed


def remainder(id, divisor):
    """CRC-32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor)).cast("int")


def labelled_sample(docs, labels, label, rows, divisor, held_out, id="doc_id", text="text"):
    """At most ``rows`` documents with their 0/1 label, none of them held out: ``(id, text, label)``.

    The documents are chosen by a hash of their id, the same in every run. Only their ids and
    labels are sent to all tasks, which ``rows`` bounds. A document with several labels takes the
    largest; null labels and null ids are left out.
    """
    known = (
        labels.select(F.col(id).alias("k"), F.col(label).cast("int").alias("y")).filter("k IS NOT NULL AND y IN (0, 1)")
        .groupBy("k").agg(F.max("y").alias("y"))
        .filter(remainder(F.col("k"), divisor) != held_out)
    )
    chosen = known.orderBy(F.xxhash64(F.col("k").cast("string")), "k").limit(rows)
    texts = docs.select(F.col(id).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "k")


def within_bytes(prepared, limit):
    """Rows ``(k, y, x)`` of a sample on the driver: whole documents, in the order of their hash, up to ``limit`` bytes of ``x``.

    What does not fit is left out as a document, never shortened. Tasks prepare ``x`` once; the driver
    gets the sizes of the sampled rows first, then the rows it takes. The order is the same in every run.
    """
    prepared = checkpointed(prepared.withColumn("order", F.xxhash64(F.col("k").cast("string"))))
    sizes = prepared.select("order", F.length("x").alias("size")).orderBy("order", "size").collect()
    taken, total = None, 0
    for row in sizes:
        total += row["size"]
        if total > limit and taken is not None:
            break
        taken = row["order"]
    if taken is None:
        return []
    rows = prepared.filter(F.col("order") <= taken).select("k", "y", "x").collect()
    return sorted(((row["k"], row["y"], bytes(row["x"])) for row in rows), key=lambda row: (str(row[0]), row[1], row[2]))
