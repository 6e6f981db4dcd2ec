"""What must not grow faster than the input: work repeated by an expression, and copies of what a query needs."""

import random
from datetime import UTC, datetime
from statistics import median

from pyspark.sql import functions as F

from mailgrove.functions import addresses, dates, extract, identity
from mailgrove.llm.shared import components
from mailgrove.plans import catalog

NOW = 1_779_062_556_000_000
DAY = 86_400_000_000


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _slow_date(options):
    first = int(datetime(dates.FIRST_YEAR, 1, 1, tzinfo=UTC).timestamp()) * 1_000_000
    ok = sorted(x for x in options or [] if x is not None and first <= x <= NOW + dates.AHEAD_DAYS * DAY)
    if not ok:
        return None
    if len(ok) <= 2 or ok[-1] - ok[0] <= DAY:
        return ok[0]
    mid = median(ok)
    mad = median(abs(x - mid) for x in ok)
    near = [x for x in ok if mad > 0 and 0.6745 * abs(x - mid) / mad <= dates.MODIFIED_Z]
    return near[0] if len(near) >= 2 else ok[0]


def test_select_date_works_each_step_out_once(spark):
    """the plausible dates are found once and sorted once a row, not anew wherever the expression names them; the choice is that of brute force."""
    rng = random.Random(3)
    rows = [(i, [rng.choice([None, 0, NOW * 2, NOW // 2 + rng.randrange(9) * DAY // 3, NOW // 2 + rng.randrange(400) * DAY]) for _ in range(i % 9)]) for i in range(400)] + [(400, None)]
    df = spark.createDataFrame(rows, "id long, options array<long>")
    made = df.select("id", dates.select_date(F.col("options"), F.lit(NOW)).alias("date"))
    assert {r["id"]: r["date"] for r in made.collect()} == {i: _slow_date(of) for i, of in rows}
    assert _optimized(made).count("filter(options") == 1


def test_plain_pseudonyms_are_those_of_python(spark):
    """plain identities never reach Python, and whatever path a text takes, its pseudonym is the same."""
    rng = random.Random(7)
    pieces = ["Ann", "B.", "é", " ", "  ", "\t", "<", ">", "@", ",", ": ", ";", "a@b.cc", "x.y@host", "<a@b.cc>", " <q+r@s-t.example>", "\n", "a", "#1", "(a)", "\u00a0", "\u2003", "漢", "-"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(7))) for _ in range(4000)] + ["Supplier#000000001 <supplier.000000001@suppliers.example>", "Zoë Müller <z@m.example>", "dev@lists.example", "a@b", "no address", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    rows = df.select("id", identity.pseudonymise(F.col("text")).alias("one"), identity.pseudonymise_list(F.array("text", F.lit("N <n@o.pp>"))).alias("many"), identity._plain(F.col("text")).alias("plain")).collect()
    last = identity.pseudonymise_text("N <n@o.pp>")
    for r in rows:
        text = texts[r["id"]]
        assert r["one"] == (None if text is None else identity.pseudonymise_text(text)) and r["many"] == [identity.pseudonymise_text(text or ""), last]
    assert all(r["plain"] for r in rows[4000:])


def test_pseudonyms_are_made_once(spark):
    """the optimizer's filter on the number of trailers doesn't have the pseudonyms made a second time."""
    assert _optimized(catalog.queries()["anonymize_trailers"](spark, "/root/testdata/sf0.001")).count("EvalPython") == 1


def _slow_trailers(body):
    """Every part by the one pattern, each trailer matched again for each part."""
    text = F.regexp_replace(F.regexp_replace(F.element_at(F.split(body, extract.SIGNATURE, 2), 1), extract.WRAPPED_REFERENCE, "$1 $2"), extract.WRAPPED_MAIL, "$1 $2")
    trim = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")
    part = lambda t, i: trim(F.regexp_extract(t, extract.TRAILER, i))
    made = F.transform(F.regexp_extract_all(text, F.lit(extract.TRAILER), 0), lambda t: F.struct(part(t, 1).alias("a"), addresses.normalize_address(F.concat(part(t, 2), F.lit(" <"), part(t, 3), F.lit(">"))).alias("b")))
    return F.coalesce(made, F.array().cast("array<struct<a:string,b:string>>"))


def test_trailers_are_those_of_the_pattern(spark):
    """taken apart without the pattern, trailers are what the pattern finds, on odd bodies too."""
    rng = random.Random(11)
    pieces = ["Acked-by", "x-by", "-by", ":", ": ", " ", "\n", "\n", "\t", "A B", "é", "<", ">", "<a@b.cc>", "<a at b.cc>", "<a(a)b.cc>", "\u00a0", "\u2003", "\x85", "\n<q@r.ss>", "Fixes: ab (x\ny)", "\n-- \n", "\r", "\x0b", "z"]
    bodies = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(6000)]
    bodies += [f"{rng.choice(pieces)}\nAcked-by:{rng.choice(pieces)}A{rng.choice(pieces)}{rng.choice(pieces)}<{rng.choice(pieces)}a@b.cc{rng.choice(pieces)}>\nTested-by: C <c@d.ee>" for _ in range(3000)] + [None, ""]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id long, body string")
    rows = df.select("id", extract.trailers(F.col("body")).alias("fast"), _slow_trailers(F.col("body")).alias("slow")).collect()
    assert all([tuple(t) for t in r["fast"]] == [tuple(t) for t in r["slow"]] for r in rows) and sum(len(r["fast"]) for r in rows) > 3000


def test_trailers_are_found_once(spark):
    """a body is searched once, and addresses that nothing asks for are not made."""
    plan = _optimized(catalog.queries()["trailer_counts"](spark, "/root/testdata/sf0.001"))
    assert plan.count("regexp_extract_all(") == 1 and "suppliers.example" in plan and "RLIKE" not in plan


def test_components_of_many_edges(spark):
    """what tells that components have settled stays within a long however many edges there are."""
    pairs = spark.range(90_000).select((F.col("id") * 2).alias("a"), (F.col("id") * 2 + 1).alias("b"))
    got = components(pairs).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("root") == F.col("node") - F.col("node") % 2).alias("right")).first()
    assert (got["n"], got["right"]) == (180_000, 180_000)
