"""The registered queries against their SQL, and the pipeline stage by stage."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline as P
import parity
from merchantlake.llm.queries import ORACLE, QUERIES
from test_quality_rules import counted
from test_simhash_trie import shingles
from test_suffix_dedup import brute as removed


def test_entry_registers_all_operators_and_the_pipeline():
    names = entry_point.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_oracle(spark, sf_dir, name):
    assert parity.compare(QUERIES[name](spark, sf_dir), parity.connect(sf_dir), ORACLE[name]) is None


def test_suffix_dedup_query_equals_brute_force(spark, sf_dir, rows):
    docs = sorted((x.doc_id, x.text) for x in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    expected = sorted(((d, *r) for (d, _), r in zip(docs, removed([t for _, t in docs]))), key=repr)
    assert rows(QUERIES["op1_suffix_dedup"](spark, sf_dir)) == expected


def test_stages_do_what_their_operators_decide(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 90")
    stage = dict(P.STAGES)
    assert list(stage) == ["quality_rules", "simhash_near_dedup", "suffix_dedup", "decontamination", "source_mix"]

    def texts(df):
        return {x.doc_id: x.text for x in df.collect()}

    ruled = stage["quality_rules"](spark, docs, sf_dir)
    assert ruled.columns == docs.columns
    assert all(not counted(t)[5] for t in texts(ruled).values())
    alone = stage["simhash_near_dedup"](spark, ruled, sf_dir)
    assert alone.columns == docs.columns
    before = texts(ruled)
    assert set(texts(alone)) <= set(before) and set(texts(alone).values()) <= set(before.values())
    # Every text that went has one that stayed with similar shingles, or a chain to one.
    shared = lambda a, b: len(a & b) / max(1, len(a | b))
    sets = {d: shingles(t) for d, t in before.items()}
    for d in set(before) - set(texts(alone)):
        assert max(shared(sets[d], sets[o]) for o in before if o != d) >= 0.65
    for d in texts(alone):
        assert all(shared(sets[d], sets[o]) < 0.93 for o in texts(alone) if o != d)
    cut = stage["suffix_dedup"](spark, alone, sf_dir)
    assert cut.columns == docs.columns and set(texts(cut)) == set(texts(alone))
    order = sorted(texts(alone).items())
    left = texts(cut)
    for (doc, text), (_, n, *_) in zip(order, removed([t for _, t in order])):
        after = left[doc]
        assert len(text.encode()) - n - 60 <= len(after.encode()) <= len(text.encode()) - n
    assert cut.where("n_chars != char_length(text)").count() == 0
    clean = stage["decontamination"](spark, cut, sf_dir)
    assert clean.columns == docs.columns and set(texts(clean)) <= set(texts(cut))
    mixed = stage["source_mix"](spark, clean, sf_dir)
    assert set(docs.columns) < set(mixed.columns) and mixed.where("taken <= 0").count() == 0
    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in texts(clean).items()}
    assert all(sizes[x.doc_id] == x["size"] and x.taken % max(1, x["size"]) == 0 for x in mixed.collect())


def test_stages_take_awkward_rows_and_none(spark, awkward, no_documents, sf_dir):
    for docs in (awkward.select("doc_id", "text", "lang", "source", "n_chars"), no_documents):
        for name, stage in P.STAGES:
            got = stage(spark, docs, sf_dir)
            assert set(docs.columns) <= set(got.columns), name
            got.select(F.count(F.lit(1))).collect()


def test_run_gives_the_last_stage(spark, sf_dir):
    got = P.run(spark, sf_dir)
    assert got.count() > 0 and "taken" in got.columns
