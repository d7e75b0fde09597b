"""Benchmark decontamination by templates.

Texts become sequences of tokens in which numbers, units after numbers, and names inside sentences are typed placeholders.
Windows of tokens of the benchmark's items are looked up by hash in the windows of every document. What the placeholders
stood for has to map one to one from an item to a document within an alignment, so a question asked again with other
numbers or names is found, and text that only looks alike is not. Each window is looked up without regard to case, too:
with its names as words and, where most of it is numbers, with these as they are.

Few places of a document can begin a window of the benchmark: each of the benchmark's windows has two tokens, its anchors, that every
match of it holds as they are, and windows are made where two tokens that anchor any window are close enough. This leaves
out no match. A benchmark with more anchors than a plan should hold is looked up at every place.

Defined results: a null or empty text has no tokens. In scripts without spaces each character is a token. Items with no
more tokens than a window have windows of one token less; items below ``MIN_TOKENS`` match by all their tokens as they are,
and an item of one token cannot be told from chance and matches nothing. Null ids take part like others. Rows
equal in id and text get one result each. Texts of any length are cut whole. An empty table, or an empty benchmark, gives a result without matches. Other
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import packed, store, text_of

WINDOW = 10
MIN_TOKENS = 5
#: An item of fewer tokens matches nothing.
LEAST_TOKENS = 2
#: Of a window's tokens, so many at most may be placeholders; else it is taken as it is.
MAX_SLOT_SHARE = 0.5
#: A document is contaminated by an item when it covers this share of the item's tokens, or so many of them in all.
MIN_SHARE = 0.5
MIN_COVERED = 25
#: The benchmark's windows are sent to every task when there are no more than this; else both sides are shuffled.
MAX_BROADCAST_WINDOWS = 500_000
#: Different tokens that anchor the benchmark's windows, up to which they are written into the plan.
MAX_ANCHORS = 20_000

# What a token is, which tokens end a sentence, and units of measure and money.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
TOKEN = rf"[{UNSPACED}&&[\p{{L}}]]\p{{M}}*|[\p{{L}}&&[^{UNSPACED}]][[\p{{L}}\p{{M}}'’-]&&[^{UNSPACED}]]*|\d+(?:[.,]\d+)*|[%$€£]|[.!?\n]"
ENDS = (".", "!", "?", "\n")
UNITS = (
    "% $ € £ mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound pounds ml l liter liters "
    "gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "mph kph dollar dollars euro euros cent cents percent degrees"
).split()


def _tagged(tokens: Column) -> Column:
    """Each token in lower case with its kind: e end of sentence, n number, u unit, p proper name, w word."""

    def tag(x: Column, i: Column) -> Column:
        low, before = F.lower(x), F.get(tokens, i - 1)
        number = (x >= "0") & (x < ":")
        after_number = F.coalesce((before >= "0") & (before < ":"), F.lit(False))
        inside = F.coalesce(~before.isin(*ENDS), F.lit(False))
        kind = (
            F.when(x.isin(*ENDS), "e")
            .when(number, "n")
            .when(after_number & low.isin(UNITS), "u")
            .when(inside & (x != low) & (x != F.upper(x)), "p")
            .otherwise("w")
        )
        return F.struct(low.alias("v"), kind.alias("k"))

    return F.filter(F.transform(tokens, tag), lambda t: t["k"] != "e")


# What a window is compared by: its template with names as placeholders, the same with names as words, or as both at once
# when it has no names.
TEMPLATE, CASELESS = 1, 2


def _hashed(words: str):
    """A token's hash with all kinds but ``words`` as placeholders."""
    return lambda t: F.xxhash64(F.when(t["k"].isin(*words), t["v"]).otherwise(F.concat(F.lit("<"), t["k"], F.lit(">"))))


def _kept(words: str):
    """A token's value where it is a placeholder."""
    return lambda t: F.when(~t["k"].isin(*words), t["v"])


def _windows(starts: Column, size: int) -> Column:
    """Windows of ``size`` tokens of ``t`` at some places: place, hash, values of the slots, and form (``TEMPLATE``, ``CASELESS`` or both)."""

    def window(w: Column, tokens: Column, values: Column, form: Column) -> Column:
        return F.struct(w["i"].alias("at"), F.lit(size).alias("size"), F.xxhash64(F.lit(size), tokens).alias("hash"), values.alias("values"), form.alias("form"))

    def few(values: Column) -> Column:
        return (F.size(values) <= size * MAX_SLOT_SHARE) & F.lit(size >= MIN_TOKENS)

    def of(w: Column) -> Column:
        slots = F.array_compact(F.transform(w["w"], _kept("w")))
        numbers = F.array_compact(F.transform(w["w"], _kept("wp")))
        return F.struct(w["i"].alias("i"), w["w"].alias("w"), slots.alias("slots"), numbers.alias("numbers"))

    def caseless(w: Column) -> Column:
        both = few(w["slots"]) & (F.size(w["slots"]) == F.size(w["numbers"]))
        as_words = window(w, F.transform(w["w"], _hashed("wp")), w["numbers"], F.when(both, TEMPLATE + CASELESS).otherwise(CASELESS))
        literal = window(w, F.transform(w["w"], lambda t: F.xxhash64(t["v"])), F.slice(w["numbers"], 1, 0), F.lit(CASELESS))
        return F.when(few(w["numbers"]), as_words).otherwise(literal)

    def with_names(w: Column) -> Column:
        named = few(w["slots"]) & (F.size(w["slots"]) > F.size(w["numbers"]))
        return F.when(named, window(w, F.transform(w["w"], _hashed("w")), w["slots"], F.lit(TEMPLATE)))

    cut = F.transform(starts, lambda i: F.struct(i.alias("i"), F.slice("t", i, size).alias("w")))
    return F.flatten(F.transform(F.transform(cut, of), lambda w: F.array_compact(F.array(caseless(w), with_names(w)))))


def _everywhere(size: int) -> Column:
    """All places of ``t`` where a window of ``size`` tokens can begin."""
    n = F.size("t")
    return F.when(n >= size, F.sequence(F.lit(1), n - size + 1))


def _listed(shaped: DataFrame, keys: list[str], windows: Column, names: list[str]) -> DataFrame:
    """A row for each window. The outer form keeps Spark from testing the windows' number in a filter before: such a filter is
    moved below the tokens, is computed from the text once more, and for each token again.
    """
    return shaped.select(*keys, F.inline_outer(windows)).toDF(*keys, *names).where("hash is not null")


def tagged(texts: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and, from ``text``, its tokens ``t`` in lower case with their kinds."""
    found = texts.select(*keys, F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)).alias("tokens"))
    return found.select(*keys, _tagged(F.col("tokens")).alias("t"))


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """item, n_tokens, at, size, hash, values, form of every window of every item."""
    named = items.select(F.col(f"`{item_id}`").alias("item"), text_of(F.col(f"`{text}`")).alias("text"))
    shaped = tagged(named, "item").withColumn("n_tokens", F.size("t"))

    def of_size(size: int) -> Column:
        windows = _windows(_everywhere(size), size)
        return F.transform(windows, lambda w: F.struct(w["at"], w["size"], w["hash"], w["values"], w["form"], _anchors(F.slice("t", w["at"], size)).alias("anchors")))

    # A short item has windows of one token less, one case for each length: its first word begins a sentence, and would be
    # a name where a document goes on without one.
    cases = F.when(F.col("n_tokens") > window, of_size(window))
    for n in range(LEAST_TOKENS, window + 1):
        cases = cases.when(F.col("n_tokens") == n, of_size(n if n < MIN_TOKENS else max(MIN_TOKENS, n - 1)))
    return _listed(shaped, ["item", "n_tokens"], cases, ["at", "size", "hash", "values", "form", "anchors"])


def _anchors(window: Column) -> Column:
    """Two tokens of a window that stand as they are in each of its forms: words, else words and names, else any; long ones are rare."""
    plain, words = F.filter(window, lambda t: t["k"] == "w"), F.filter(window, lambda t: t["k"].isin("w", "p"))
    from_ = F.when(F.size(plain) > 1, plain).when(F.size(words) > 1, words).otherwise(window)
    longest = F.sort_array(F.transform(from_, lambda t: F.struct((-F.length(t["v"])).alias("n"), t["v"].alias("v"))))
    return F.transform(F.slice(longest, 1, 2), lambda t: t["v"])


def _near(hits: Column, size: int) -> Column:
    """Places of windows that hold two neighbouring hits."""

    def between(j: Column) -> Column:
        a, b = F.get(hits, j - 1), F.get(hits, j)
        return F.when(b - a < size, F.sequence(F.greatest(F.lit(1), b - size + 1), F.least(a, F.size("t") - size + 1)))

    pairs = F.transform(F.sequence(F.lit(1), F.size(hits) - 1), between)
    return F.when(F.size("t") >= size, F.array_distinct(F.flatten(F.array_compact(pairs))))


def document_windows(keyed: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """doc, th, at, size, hash, values, form of the windows of documents that can match any of the known ones."""
    shaped = tagged(keyed, "doc", "th")
    anchors = known.select(F.explode("anchors").alias("v")).distinct()
    few = anchors.limit(MAX_ANCHORS + 1).collect()
    if len(few) > MAX_ANCHORS:
        places = {s: _everywhere(s) for s in sizes}
    else:
        values = [r.v for r in few]
        hit = F.transform("t", lambda x, i: F.when(x["v"].isin(values), i + 1))
        shaped = shaped.select("doc", "th", "t", F.array_compact(hit).alias("hits"))
        places = {s: F.when(F.size("hits") > 1, _near(F.col("hits"), s)) for s in sizes}
    windows = F.flatten(F.array_compact(F.array(*[_windows(places[s], s) for s in sizes])))
    return _listed(shaped, ["doc", "th"], windows, ["at", "size", "hash", "values", "form"])


def _covered(starts: Column) -> Column:
    """Tokens covered by windows (at, size) in order of place."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        F.sort_array(starts),
        zero,
        lambda s, w: F.struct(
            F.greatest(s["end"], w["at"] + w["size"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), w["at"] + w["size"] - F.greatest(s["end"], w["at"]))).alias("n"),
        ),
        lambda s: s["n"],
    )


def matches(keyed: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc, th, item, covered, share, exact: documents that hold enough of an item. ``keyed`` has doc, th, text."""
    known = store(items, "item-windows")
    sizes = [r[0] for r in known.select("size").distinct().collect()]  # at most one for each window length
    if not sizes:
        sizes = [window]
    of_docs = document_windows(keyed, known, sorted(sizes)).alias("d")
    small = known.count() <= MAX_BROADCAST_WINDOWS
    of_items = (F.broadcast(known) if small else known).alias("b")
    met = of_docs.join(of_items, (F.col("d.hash") == F.col("b.hash")) & (F.col("d.size") == F.col("b.size")))
    # An alignment is judged for each form by itself: a name written as a word maps to nothing.
    forms = F.filter(F.array(F.lit(TEMPLATE), F.lit(CASELESS)), lambda f: F.col("d.form").bitwiseAND(F.col("b.form")).bitwiseAND(f) != 0)
    met = met.select("*", F.explode(forms).alias("by"))
    aligned = met.groupBy("doc", "th", "item", (F.col("d.at") - F.col("b.at")).alias("shift"), "by").agg(
        F.first("n_tokens").alias("n_tokens"),
        F.collect_set(F.struct(F.col("b.at").alias("at"), F.col("b.size").alias("size"))).alias("windows"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip(F.col("b.values").alias("x"), F.col("d.values").alias("y"))))).alias("pairs"),
    )
    ones = lambda name: F.size(F.array_distinct(F.transform("pairs", lambda p: p[name])))
    consistent = aligned.where((F.size("pairs") == ones("x")) & (F.size("pairs") == ones("y")))
    # All alignments of a document with an item, a bounded number by the length of the document.
    merged = consistent.groupBy("doc", "th", "item").agg(
        F.first("n_tokens").alias("n_tokens"), F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"),
        F.min(F.forall("pairs", lambda p: p["x"] == p["y"]).cast("int")).alias("exact"),
    )
    counted = merged.withColumn("covered", _covered(F.col("windows"))).withColumn("share", F.col("covered") / F.col("n_tokens"))
    enough = (F.col("share") >= MIN_SHARE) | (F.col("covered") >= MIN_COVERED)
    return counted.where(enough).select("doc", "th", "item", "covered", "share", (F.col("exact") == 1).alias("exact"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", carry: bool = False
) -> DataFrame:
    """doc_id, contaminated, items (sorted), n_items, largest_share, reparameterised; the input row as ``document`` if carried."""
    body = text_of(F.col(f"`{text}`"))
    keys = [F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(body).alias("th")]
    found = matches(docs.select(*keys, body.alias("text")), item_windows(benchmark, item_id))
    per_document = store(
        found.groupBy("doc", "th").agg(
            F.sort_array(F.collect_set("item")).alias("items"), F.max("share").alias("largest_share"), (~F.max("exact")).alias("reparameterised")
        ),
        "contaminated",
    )
    rows = docs.select(*keys, *([packed(docs)] if carry else [])).alias("d")
    same = F.col("d.doc").eqNullSafe(F.col("c.doc")) & (F.col("d.th") == F.col("c.th"))
    nothing = F.array().cast(per_document.schema["items"].dataType)
    return rows.join(per_document.alias("c"), same, "left").select(
        F.col("d.doc").alias("doc_id"), F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", nothing).alias("items"),
        F.coalesce(F.size("items"), F.lit(0)).alias("n_items"), F.coalesce("largest_share", F.lit(0.0)).alias("largest_share"),
        F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"), *(["document"] if carry else []),
    )
