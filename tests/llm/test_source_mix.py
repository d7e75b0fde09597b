import random
import re

import pytest

from merchantlake.llm.source_mix import mix_sources, source_targets


def filled(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing out again and again what is above a cap."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = float(sum(sizes.values())), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] >= cap * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: float(cap * sizes[s]) for s in over})
        if len(fixed) == len(names):
            return fixed


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_repeated_sharing(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{k}": r.choice([0, 1, 5, 50, 1000, 20_000]) for k in range(r.randint(1, 9))} | {None: 7}
    got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, size bigint")).collect()
    expected = filled(sizes)
    assert {x.source: x.target for x in got} == pytest.approx(expected)


def test_takes_come_near_targets_and_no_document_is_taken_too_often(spark):
    r = random.Random(3)
    rows = [(k, " ".join("w" * 3 for _ in range(r.randint(0, 40))), r.choice(["a"] * 6 + ["b", "c", None])) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    first, again = (sorted(map(tuple, mix_sources(docs.repartition(n), carry=False).drop("document").collect()), key=repr) for n in (3, 7))
    assert first == again and len(first) == len(rows)
    taken, target, size = {}, {}, {}
    for _, source, n, total, goal, took in first:
        assert took in {n * k for k in range(4)}
        taken[source] = taken.get(source, 0) + took
        size[source] = size.get(source, 0) + n
        target[source], = {goal}
        assert total is not None
    assert target == pytest.approx(filled(size))
    assert all(abs(taken[s] - target[s]) <= 40 for s in target)


def test_awkward_rows(awkward):
    got = mix_sources(awkward)
    assert got.count() == awkward.count()
    words = {(x.doc_id, x.text): len(re.findall(r"[^\x20\x09-\x0D]+", x.text or "")) for x in awkward.collect()}
    for x in got.collect():
        assert x["size"] == words[x.document.doc_id, x.document.text] and 0 <= x.taken <= 3 * x["size"]
        assert x.document.target == "x"
    same = [x.taken for x in got.where("doc_id = 5").collect()]
    assert len(set(same)) == 1


def test_no_documents_and_no_words(spark, no_documents):
    assert mix_sources(no_documents).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert [(x["size"], x.target, x.taken) for x in mix_sources(empty).collect()] == [(0, 0.0, 0)] * 2
