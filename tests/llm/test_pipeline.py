"""The pipeline's stages against brute force, and on odd rows."""

import hashlib
import re
import zlib

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from conftest import plan_text
from test_pairs import closure, shingled

import corpus_pipeline as pipeline
from tagloom.llm import byte_pairs, mixing
from tagloom.llm.queries import MIX, MIX_BLOCK, MIX_OTHER, RANKS
from tagloom.llm.scratch import Scratch

SMALL = "/root/testdata/sf0.001"
ODD = [
    (90_001, None, "en", "src0", 0), (90_002, "", "en", None, 0), (90_003, " !! 12 ", None, "x", 0), (None, "the and of that with", "en", "src1", 20),
    (90_004, "The same words of that and with this here. " * 5, "en", "src1", 9), (90_004, "The same words of that and with this here. " * 5, "en", "src1", 9),
    (90_005, "THE SAME words of that\tand with this here. " * 5, "en", "src2", 9), (90_006, "the and of that " * 30_000, "en", "src3", 1),
    (90_007, "idiot moron idiot stupid clown scum", "en", "src3", 1),
]


def brute_near(rows):
    """Ids kept: the smallest of each group of five-word near-duplicates."""
    sets = {r.doc_id: shingled(r.text, 5) for r in rows if r.doc_id is not None}
    ids = sorted(sets)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = closure(ids, linked)
    return {i for i in ids if low[i] == i}


def brute_mix(rows):
    """Ids in the order of the mix."""
    weights = {**MIX, mixing.OTHER: MIX_OTHER}
    pools = {}
    for r in rows:
        pools.setdefault(r.source if r.source in MIX else mixing.OTHER, []).append(r.doc_id)
    slots = {(pool, turn): place for pool, turn, place in mixing.windows_in_sql(weights)}
    placed = []
    for pool, ids in pools.items():
        ids.sort(key=lambda i: hashlib.md5(("" if i is None else str(i)).encode()).hexdigest())
        for rank, i in enumerate(ids):
            turn, share = rank // MIX_BLOCK, weights[pool]
            placed.append((turn // share * sum(weights.values()) + slots[pool, turn % share], rank % MIX_BLOCK, i))
    return [i for _, _, i in sorted(placed, key=lambda x: x[:2])]


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.union(spark.createDataFrame(ODD, docs.schema))
    for name in ("lang_pred", "lang_score", "toxicity", "digest", "pool", "ids", "component"):
        docs = docs.withColumn(name, F.lit("clash"))
    scratch, found = Scratch(spark, "t"), []
    for name, stage in pipeline.STAGES:
        out = scratch.keep(stage(spark, docs, SMALL), name)
        if name != "byte_pairs":
            assert out.columns == docs.columns
        found.append((docs, out))
        docs = out
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is None, i or 0))

    before, after = found[0]
    assert set(ids(before)) - set(ids(after)) == {90_001, 90_002, 90_003}

    before, after = found[1]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    gone = set(ids(before)) - set(ids(after))
    assert gone and not any(labels.get(i) == 0 for i in gone)

    before, after = found[2]
    rows = before.select("doc_id", "text").collect()
    assert ids(after) == sorted(brute_near(rows)) + [r.doc_id for r in rows if r.doc_id is None]

    before, after = found[3]
    assert [r.doc_id for r in after.select("doc_id").collect()] == brute_mix(before.select("doc_id", "source").collect())

    before, after = found[4]
    ranks = byte_pairs.read_ranks(public_tokenizers.path(RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
    rows = after.collect()
    assert len(rows) == len(texts) and all(r.ids == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.decoded_same for r in rows)


def test_last_stage_states_the_order_of_the_mix(spark, folder):
    """Part files of unequal size, the largest last: a scan returns them in another order than they were written."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.repeat("text", 5)).otherwise(F.col("text")))
    for i, (low, high) in enumerate([(0, 5), (5, 20), (20, 50), (50, 100)]):
        docs.where(F.col("doc_id") % 100 >= low).where(F.col("doc_id") % 100 < high).coalesce(1).write.mode("append").parquet(folder)
    docs = spark.read.parquet(folder)
    mixed = pipeline.mix_sources(spark, docs, SMALL).withColumn("at", F.monotonically_increasing_id())
    mixed.repartitionByRange(5, "at").drop("at").write.parquet(f"{folder}-mixed")
    read = spark.read.parquet(f"{folder}-mixed")
    rows = pipeline.tokenize(spark, read, SMALL).select("doc_id", "pool", "slot", "position", "decoded_same").collect()
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.position)] == brute_mix(docs.select("doc_id", "source").collect())
    assert all(r.slot == r.position // MIX_BLOCK and r.decoded_same for r in rows)


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_held_out_rows_follow_crc32(spark):
    from tagloom.llm.language import held_out

    got = spark.range(-50, 400).select("id", held_out(F.col("id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_toxicity_stage_shuffles_alike_for_few_and_many_labels(spark, table, folder, monkeypatch):
    """The stage learns from texts that pass one exchange, whether or not labels are few enough to broadcast."""
    docs = table([(i, f"reto theon {'idiot' if i % 3 == 0 else 'calm'} {i}") for i in range(60)], "doc_id long, text string")
    table([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    plans, keep = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name: plans.append(plan_text(df)) or keep(self, df, name))
    before, found = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            del plans[:]
            kept = sorted(r.doc_id for r in pipeline.remove_toxic(spark, docs, folder).collect())
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        found.append((kept, sum("text#" in x for x in re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput[^\n]*", plans[0]))))
    assert found == [([i for i in range(60) if i % 3], 1)] * 2
