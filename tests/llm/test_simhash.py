import random

import xxhash
from pyspark.sql import functions as F

from microtally.llm import operators, simhash  # noqa: F401
from microtally.llm.components import connected_components
from microtally.llm.registry import QUERIES
from tests.llm.cases import AWKWARD, SF_DIR, awkward, clashing, components, table


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for gap in "\t\n\x0b\x0c\r":
        lower = lower.replace(gap, " ")
    words = [word for word in lower.split(" ") if word]
    if not words:
        return 0
    shingles = [" ".join(words[n:n + 3]) for n in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def expected(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    values = sorted(set(prints))
    pairs = [(a, b) for n, a in enumerate(values) for b in values[n + 1:] if (a ^ b).bit_count() <= 2]
    group = components(values, pairs)
    first = {}
    for (doc_id, _), fp in zip(rows, prints):
        if doc_id is not None:
            first[group[fp]] = min(doc_id, first.get(group[fp], doc_id))
    return sorted(repr((doc_id, f"{fp:016x}", first.get(group[fp]))) for (doc_id, _), fp in zip(rows, prints))


def test_whole_table(spark):
    found = sorted(repr(tuple(row)) for row in QUERIES["op7_simhash_dedup"](spark, SF_DIR).collect())
    assert found == expected([(row["doc_id"], row["text"]) for row in table("documents")])


def test_awkward_rows(spark, tmp_path):
    awkward(spark).write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(repr(tuple(row)) for row in QUERIES["op7_simhash_dedup"](spark, str(tmp_path)).collect())
    assert found == expected([(row[0], row[1]) for row in AWKWARD])


def test_all_pairs_within_two_bits_are_found(spark):
    draw = random.Random(3)
    seeds = [draw.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    values = set(seeds)
    for seed in seeds:
        for flips in (1, 1, 2, 2, 2, 3, 4):
            value = seed
            for bit in draw.sample(range(64), flips):
                value ^= 1 << bit
            values.add(value)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    for distance in (0, 1, 2, 3):
        found = {(row.a, row.b) for row in simhash.close_fingerprints(frame, distance=distance).collect()}
        ordered = sorted(map(signed, values))
        mask = (1 << 64) - 1
        assert found == {(a, b) for n, a in enumerate(ordered) for b in ordered[n + 1:] if ((a ^ b) & mask).bit_count() <= distance}


def test_one_row_of_each_group_stays(spark):
    docs = clashing(awkward(spark))
    stay = simhash.one_of_each_group(docs)
    assert stay.columns == docs.columns
    rows = stay.collect()
    groups = {line.rsplit(",", 1)[0].split(", ", 1)[1] for line in expected([(row[0], row[1]) for row in AWKWARD])}
    assert len(rows) == len(groups)
    assert sorted((row.doc_id is None, row.doc_id or 0) for row in rows) == [(False, -8), (False, 1), (False, 3), (False, 6), (False, 7), (False, 9), (False, 10), (True, 0)]
    assert simhash.one_of_each_group(awkward(spark, [])).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(5)
    pairs = [(n, n + 1) for n in range(100, 160)] + [(5, n) for n in range(200, 260)] + [(7, 7), (300, 301), (301, 300)]
    pairs += [(draw.randrange(400, 500), draw.randrange(400, 500)) for _ in range(60)]
    frame = spark.createDataFrame([*pairs, (None, 3)], "x long, y long")
    found = {row.node: row.component for row in connected_components(frame, "x", "y").collect()}
    real = [(a, b) for a, b in pairs if a != b]
    assert found == components({node for pair in real for node in pair}, real)
    assert connected_components(frame.filter(F.lit(False)), "x", "y").count() == 0
