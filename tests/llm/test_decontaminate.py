import pytest
from pyspark.sql import functions as F

from awkward import prose
from merchantlake.llm import decontaminate as D

ITEMS = [
    (1, "A train leaves Boston at 60 km per hour and reaches Chicago after 5 hours of travel on the old line."),
    (2, "Short item of six words here."),
    (3, None),
    (4, "tiny"),
    (5, "nine words make one item that is just short"),
    (6, prose(77, 30)),
]
SAME = "A train leaves Boston at 60 km per hour and reaches Chicago after 5 hours of travel on the old line."
OTHER = "a train leaves Denver at 75 km per hour and reaches Austin after 9 hours of travel on the old line"
MUDDLED = "A train leaves Denver at 75 km per hour and reaches Denver after 75 hours of travel on the old line."
DOCS = [
    (1, prose(1, 30) + " " + SAME + " " + prose(2, 30), [1], False),
    (2, prose(3, 30) + " so " + OTHER + " " + prose(4, 10), [1], True),
    (3, MUDDLED, [], False),
    (4, "before it all short item of six words here after it", [2], False),
    (5, prose(77, 30).upper(), [6], False),
    (6, " ".join(prose(77, 30).split()[:14]) + " " + prose(5, 50), [], False),
    (7, " ".join(prose(77, 30).split()[:20]) + " " + prose(5, 50), [6], False),
    (8, prose(6, 200), [], False),
    (9, "tiny " * 30, [], False),
    (10, (SAME + " ") * 50, [1], False),
]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id int, text string").withColumn("hash", F.lit("x"))


@pytest.mark.parametrize("limit, anchors", [(D.MAX_BROADCAST_WINDOWS, D.MAX_ANCHORS), (0, D.MAX_ANCHORS), (D.MAX_BROADCAST_WINDOWS, 1)])
def test_finds_items_and_leaves_the_rest(spark, benchmark, monkeypatch, limit, anchors):
    monkeypatch.setattr(D, "MAX_BROADCAST_WINDOWS", limit)
    monkeypatch.setattr(D, "MAX_ANCHORS", anchors)
    docs = spark.createDataFrame([d[:2] for d in DOCS], "doc_id bigint, text string")
    got = {x.doc_id: x for x in D.contaminated(docs, benchmark).collect()}
    assert {k: x["items"] for k, x in got.items()} == {d: items for d, _, items, _ in DOCS}
    assert all(x.contaminated == bool(x["items"]) == (x.n_items > 0) for x in got.values())
    assert {k for k, x in got.items() if x.reparameterised} == {d for d, _, _, other in DOCS if other}


def test_awkward_rows(awkward, benchmark, spark):
    assert D.contaminated(awkward, benchmark, carry=True).where("document.item = 'x' and not contaminated").count() == awkward.count()
    shared = awkward.where("doc_id = 6 and source is null").select(F.lit(1).alias("item_id"), "text")
    found = D.contaminated(awkward, shared).where("contaminated").collect()
    assert sorted(x.doc_id for x in found if x.doc_id is not None) == [5, 5, 6, 7, 13, 14] and sum(x.doc_id is None for x in found) == 1


def test_nothing_to_compare(spark, no_documents, benchmark, awkward):
    assert D.contaminated(no_documents, benchmark).count() == 0
    assert D.contaminated(awkward, benchmark.limit(0)).where("contaminated").count() == 0


def test_placeholders_have_types(spark):
    texts = spark.createDataFrame([("It cost 5 km, said Bob. Then UPPER 3.5 % more",)], "text string")
    tokens = F.regexp_extract_all("text", F.lit(D.TOKEN), F.lit(0))
    tagged = texts.select(tokens.alias("tokens")).select(D._tagged(F.col("tokens")).alias("t")).first().t
    assert [(t.v, t.k) for t in tagged] == [
        ("it", "w"), ("cost", "w"), ("5", "n"), ("km", "u"), ("said", "w"), ("bob", "p"), ("then", "w"), ("upper", "w"),
        ("3.5", "n"), ("%", "u"), ("more", "w"),
    ]


def found(spark, items, docs):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    given = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    return [x["items"] for x in D.contaminated(given, benchmark).orderBy("doc_id").collect()]


def test_windows_of_slots_and_short_items_match_as_they_are(spark):
    items = [
        "What is 12 + 7 * 3 - 45 / 9?", "The Old Man And The Sea By Ernest Miller Hemingway Of Oak Park", "Who wrote Hamlet?",
        "長江是亞洲最長的河流嗎", "光合作用",
    ]
    wrap = lambda x: f"{prose(1, 20)}. {x} {prose(2, 20)}"
    docs = [wrap(x) for x in items] + [
        wrap("What is 13 + 8 * 4 - 46 / 8?"), wrap("The Young Girl And The Hill By Anna Maria Smithson Of Elm Road"), wrap("Who wrote Macbeth?"),
        wrap("我們知道長江是亞洲最長的河流嗎請回答"), wrap("合作光用"),
    ]
    assert found(spark, items, docs) == [[0], [1], [2], [3], [4], [], [], [], [3], []]


def test_names_in_another_case(spark):
    german = "Der Zug verlässt den Bahnhof der Stadt um 9 Uhr und erreicht das Dorf am Fluss nach 3 Stunden Fahrt"
    docs = [prose(1, 20) + " " + x + " " + prose(2, 20) for x in (SAME.lower(), SAME.upper(), german.lower(), german.upper(), SAME.title(), MUDDLED.lower())]
    assert found(spark, [SAME, german], docs) == [[0], [0], [1], [1], [0], []]
    other = SAME.lower().replace("60", "75").replace("after 5", "after 9")
    assert found(spark, [SAME], [other]) == [[0]]


def test_a_text_is_cut_into_tokens_once(spark, benchmark):
    """A filter on the windows, moved below the tokens, would do it again for each token: time would grow with the square of a length."""
    docs = spark.createDataFrame([(1, 1, "x")], "doc bigint, th bigint, text string")
    plan = D.document_windows(docs, D.item_windows(benchmark), [10])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_windows_at_anchors_hold_every_match(spark, benchmark):
    """The windows made near anchors are those of all places that meet the benchmark."""
    keyed = spark.createDataFrame([(d[0], 0, d[1]) for d in DOCS], "doc bigint, th bigint, text string")
    known = D.item_windows(benchmark)
    sizes = sorted(r[0] for r in known.select("size").distinct().collect())
    every = D.tagged(keyed, "doc", "th").select("doc", "th", F.inline_outer(F.flatten(F.array_compact(F.array(*[D._windows(D._everywhere(s), s) for s in sizes])))))
    few = D.document_windows(keyed, known, sizes)
    met = lambda df: sorted(map(tuple, df.where("hash is not null").join(known.select("hash", "size").distinct(), ["hash", "size"]).select("doc", "at", "size", "hash").collect()))
    assert met(few) == met(every) != [] and few.count() < every.count()
