"""The queries of the Latin profile, each beside the DuckDB SQL that gives the same rows.

Units are runs of letters, their reading is the lower-cased unit, document keys are `source:doc_id`. Compounds are pairs of
adjacent long units, joined units are pairs of a short unit and a long one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexforge.functions import markup, words
from lexforge.operators import chains, dictionary, evaluate, intervals, patterns, select, units
from lexforge.runtime import table
from lexforge.sources import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_TOKENS_SQL = """with d as (select concat_ws(':', source, doc_id::varchar) k, text from documents),
 t as (select k, split_part(k, ':', 1) kind, (('0x'||substr(sha256(k),1,16))::UBIGINT % 100)::INT b, u.i, u.s surface, lower(u.s) reading
       from d, lateral (select unnest(regexp_extract_all(text,'\\p{L}+')) s, unnest(range(len(regexp_extract_all(text,'\\p{L}+')))) i) u)
"""


def query(sql: str | None, tokens: bool | str = False):
    """Register a query with its SQL; with `tokens`, the SQL starts from the tokens `t`, with "once" it reads them once."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            once = _TOKENS_SQL.replace(" t as (", " t as materialized (") if tokens == "once" else _TOKENS_SQL
            ORACLE[f.__name__] = once + sql if tokens else sql
        return f

    return add


def docs_of(spark: SparkSession, sf: str) -> DataFrame:
    return units.keyed(table(spark, sf, "documents"), "source", "doc_id")


def tokens_of(spark: SparkSession, sf: str, near: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    return units.tokens(docs_of(spark, sf), near=near)


#: Neighbours that come from a document's own array of tokens.
NEXT, LAST, SPANNED = {"nx": ("reading", 1)}, {"lf": ("reading", -1)}, {"s2": ("surface", 1), "r2": ("reading", 1)}


def train(t: DataFrame) -> DataFrame:
    return t.filter("b >= 10")


def held_out(t: DataFrame) -> DataFrame:
    return t.filter("b between 1 and 9")


def train_dictionary(t: DataFrame, min_count: int = 2) -> DataFrame:
    return dictionary.counted(train(t), ["reading", "surface"], min_count)


_DICT = """, tr as (select * from t where b >= 10),
 dict as (select reading, surface, count(*) n, round(-100 * ln(count(*)::double / (select count(*) from tr)))::INT as "cost" from tr group by all having count(*) >= {min}),
 rk as (select *, row_number() over (partition by reading order by "cost", surface) rank from dict)
"""
_DICT2 = _DICT.format(min=2)
_ATTEMPTS = (
    _DICT2
    + """, ev as (select kind, reading, surface, count(*) n from t where b between 1 and 9 group by all),
 att as (select ev.kind, ev.reading, ev.surface, ev.n, rk.rank from ev left join rk using (reading, surface)),
 at0 as (select reading, surface, sum(n)::BIGINT n, any_value(rank) rank from att group by all)
"""
)


def keys_sql(source: str, keys: str) -> str:
    """The tallies by key over attempts."""
    return f""", pl as (select *, row_number() over (partition by {keys} order by (rank is null), n desc, surface) place from {source}),
 kt as (select {keys}, sum(n)::BIGINT units, coalesce(sum(n) filter (rank is null), 0)::BIGINT missing, coalesce(sum(n) filter (rank = 1), 0)::BIGINT "first",
   coalesce(sum(n) filter (rank is not null and place = 1), 0)::BIGINT best_first, coalesce(sum(n) filter (rank <= 9), 0)::BIGINT page,
   coalesce(sum(n) filter (rank is not null and place <= 9), 0)::BIGINT best_page from pl group by {keys})
"""


# ---- documents, splits, budgets -----------------------------------------------------------------------------------


@query("""select split_part(k, ':', 1) kind, case when b = 0 then 'dev' when b < 10 then 'eval' else 'train' end split, count(*)::BIGINT docs
from (select concat_ws(':', source, doc_id::varchar) k, (('0x'||substr(sha256(concat_ws(':', source, doc_id::varchar)),1,16))::UBIGINT % 100)::INT b from documents) group by all""")
def split_counts(spark, sf):
    d = docs_of(spark, sf)
    return d.groupBy("kind", words.split_of(F.col("k")).alias("split")).agg(F.count("*").alias("docs"))


@query("""select k, chars, before from (select k, chars, coalesce(sum(chars) over (order by sha256(k), k rows between unbounded preceding and 1 preceding), 0)::BIGINT before
from (select concat_ws(':', source, doc_id::varchar) k, length(text)::BIGINT chars from documents)) where before < 300000""")
def doc_budget(spark, sf):
    d = docs_of(spark, sf).select("k", F.length("text").cast("long").alias("chars"))
    return select.hash_budget(d, "k", F.col("chars"), 300_000).select("k", "chars", "before")


_WANTED, _UNWANTED = ["ation", "ment", "heit", "ción", "tion"], ["###", "!!"]


def _two_tiers(d: DataFrame, general: int, business: int) -> DataFrame:
    first = select.order_budget(d, "doc_id", F.length("text").cast("long"), general)
    of_class = d.filter(markup.keyword_class(F.col("text"), _WANTED, _UNWANTED, 2, 1)).join(first.select("doc_id"), "doc_id", "left_anti")
    second = select.order_budget(of_class, "doc_id", F.length("text").cast("long"), business)
    tier = lambda x, name: x.select("doc_id", F.lit(name).alias("tier"), F.length("text").cast("long").alias("chars"), "before")
    return tier(first, "general").unionByName(tier(second, "business"))


@query("""with d as (select doc_id, text, length(text)::BIGINT chars from documents),
 a as (select doc_id, 'general' tier, chars, coalesce(sum(chars) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::BIGINT before from d),
 g as (select * from a where before < 400000),
 c as (select doc_id, 'business' tier, chars, coalesce(sum(chars) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::BIGINT before from d
   where doc_id not in (select doc_id from g) and contains(text,'ation')::INT + contains(text,'ment')::INT + contains(text,'heit')::INT + contains(text,'ción')::INT + contains(text,'tion')::INT >= 2
   and contains(text,'###')::INT + contains(text,'!!')::INT < 1)
select * from g union all select * from c where before < 200000""")
def two_tier_budget(spark, sf):
    return _two_tiers(table(spark, sf, "documents").select("doc_id", "text"), 400_000, 200_000)


@query("""select concat_ws(':', source, doc_id::varchar) k, len(l)::BIGINT "lines", coalesce(list_sum(list_transform(l, lambda x: length(x))), 0)::BIGINT chars
from (select source, doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') l from documents)""")
def finish_lines(spark, sf):
    d = docs_of(spark, sf).select("k", markup.finish_lines(F.col("text")).alias("l"))
    return d.select("k", F.size("l").cast("long").alias("lines"), F.aggregate(F.transform("l", lambda x: F.length(x)), F.lit(0), lambda a, x: a + x).cast("long").alias("chars"))


@query("""select concat_ws(':', source, doc_id::varchar) k, (u.n - 1)::INT line, length(u.x)::BIGINT chars,
coalesce(sum(length(u.x) + 1) over (partition by doc_id order by u.n rows between unbounded preceding and 1 preceding), 0)::BIGINT "offset"
from documents, lateral (select unnest(string_split(text, chr(10))) x, unnest(range(1, len(string_split(text, chr(10))) + 1)) n) u""")
def line_offsets(spark, sf):
    return units.lines(docs_of(spark, sf)).select("k", "line", F.length("text").cast("long").alias("chars"), F.col("offset").cast("long").alias("offset"))


@query(" select kind, count(distinct k)::BIGINT docs, count(*)::BIGINT units, sum(length(surface))::BIGINT chars from t group by kind", tokens=True)
def stats_by_kind(spark, sf):
    # A row for each document first, so that the distinct count needs no second copy of the units.
    per_doc = tokens_of(spark, sf).groupBy("kind", "k").agg(F.count("*").alias("units"), F.sum(F.length("surface")).alias("chars"))
    return per_doc.groupBy("kind").agg(F.count("*").alias("docs"), F.sum("units").alias("units"), F.sum("chars").alias("chars"))


@query(""", c as (select k, count(*) n, max(i) last from t group by k) select concat_ws(':', source, doc_id::varchar) k, coalesce(c.n, 0)::BIGINT units, (c.k is null) missing
from documents left join c on c.k = concat_ws(':', source, doc_id::varchar)""", tokens=True)
def corpus_join(spark, sf):
    """Documents with their units, and whether a document has none."""
    d = docs_of(spark, sf)
    n = units.tokens(d).groupBy("k").agg(F.count("*").alias("n"))
    return d.select("k").join(n, "k", "left").select("k", F.coalesce("n", F.lit(0).cast("long")).alias("units"), F.col("n").isNull().alias("missing"))


@query("""select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by event_id desc) rn from events) where rn = 1""")
def manifest_latest(spark, sf):
    return select.latest(table(spark, sf, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], F.col("event_id"))


# ---- pages ---------------------------------------------------------------------------------------------------------


@query("""select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) title, len(regexp_extract_all(html, '<a href="([^"]*)"', 1))::BIGINT links,
len(list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: starts_with(x, '/')))::BIGINT "local" from pages""")
def html_links(spark, sf):
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1)
    p = table(spark, sf, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), links.alias("l"))
    return p.select("page_id", "title", F.size("l").cast("long").alias("links"), F.size(F.filter("l", lambda x: x.startswith("/"))).cast("long").alias("local"))


@query(None)
def html_text(spark, sf):
    """Block-aware text lines of each page; a parser's work, so without SQL."""
    p = table(spark, sf, "pages").select("page_id", markup.html_lines("html").alias("l"))
    return p.select("page_id", F.size("l").cast("long").alias("lines"), F.array_join("l", "\n").alias("text"))


_ROBOTS = [("/en/", False), ("/*?page=", False), ("/en/1", True), ("/*ref=x$", True), ("/fr/", False), ("/fr/8", True)]


@query("""with p as (select page_id, regexp_replace(url, '^[a-z]+://[^/]*', '') path from pages),
 r(pattern, allow, re) as (values ('/en/', false, '^/en/.*'), ('/*?page=', false, '^/.*\\?page=.*'), ('/en/1', true, '^/en/1.*'), ('/*ref=x$', true, '^/.*ref=x$'), ('/fr/', false, '^/fr/.*'), ('/fr/8', true, '^/fr/8.*')),
 m as (select page_id, allow, length(pattern) n from p join r on regexp_matches(path, re)),
 b as (select page_id, arg_max(allow, (n, allow)) allow from m group by page_id)
select p.page_id, path, coalesce(b.allow, true) allowed from p left join b using (page_id)""")
def robots_rules(spark, sf):
    from lexforge.sources.robots import allowed

    p = table(spark, sf, "pages").select("page_id", F.regexp_replace("url", "^[a-z]+://[^/]*", "").alias("path"))
    return p.select("page_id", "path", allowed(F.col("path"), _ROBOTS).alias("allowed"))


# ---- dictionaries --------------------------------------------------------------------------------------------------


@query(_DICT2 + ' select reading, surface, n::BIGINT n, "cost" from dict', tokens=True)
def cost_dictionary(spark, sf):
    return train_dictionary(tokens_of(spark, sf)).select("reading", "surface", "n", "cost")


@query(_DICT2 + """ select reading, surface, "cost", reading || chr(9) || surface || chr(9) || '' || chr(9) || "cost" line from dict""", tokens=True)
def dictionary_lines(spark, sf):
    lines = train_dictionary(tokens_of(spark, sf)).withColumn("conjugation", F.lit(None).cast("string"))
    return dictionary.rendered(lines).select("reading", "surface", "cost", "line")


@query(_DICT2 + ' select reading, surface, greatest(0, "cost" + 100 - (select min("cost") from dict))::INT as "cost" from dict', tokens=True)
def cost_shift(spark, sf):
    return dictionary.shifted(train_dictionary(tokens_of(spark, sf)), 100).select("reading", "surface", "cost")


@query(""", w as (select reading, surface, count(*) n from t where b >= 10 group by all), s as (select reading, sum(n) whole from w group by reading), tot as (select sum(n) x from w)
select w.reading, w.surface, round(-100 * ln(s.whole::double / (select x from tot)))::INT whole_cost, round(-100 * ln(w.n::double / (select x from tot)))::INT own_cost from w join s using (reading) where s.whole >= 2""", tokens=True)
def whole_forms(spark, sf):
    t = train(tokens_of(spark, sf))
    n = t.groupBy("reading", "surface").agg(F.count("*").alias("n"))
    whole = n.withColumn("whole", F.sum("n").over(Window.partitionBy("reading"))).filter("whole >= 2")
    total = t.agg(F.count("*").alias("x"))
    return whole.join(F.broadcast(total)).select("reading", "surface", words.cost_of(F.col("whole"), F.col("x")).alias("whole_cost"), words.cost_of(F.col("n"), F.col("x")).alias("own_cost"))


@query(_DICT2 + """, lex as (select distinct lower(s) reading, s surface from (select unnest(regexp_extract_all(text,'\\p{L}+')) s from benchmark)),
 sf as (select surface, count(*) n from tr group by surface),
 add as (select reading, surface, coalesce(round(-100 * ln(sf.n::double / (select count(*) from tr)))::INT + 1000, 3000)::INT as "cost" from lex left join sf using (surface))
select reading, surface, min("cost")::INT as "cost" from (select reading, surface, "cost" from dict union all select * from add) group by all""", tokens=True)
def lexicon_merge(spark, sf):
    t = train(tokens_of(spark, sf))
    lexicon = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(units.TOKEN), 1)).alias("surface")).select(F.lower("surface").alias("reading"), "surface").distinct()
    seen = t.groupBy("surface").agg(F.count("*").alias("n")).join(F.broadcast(t.agg(F.count("*").alias("x"))))
    seen = seen.select("surface", (words.cost_of(F.col("n"), F.col("x")) + 1000).alias("c"))
    added = lexicon.join(seen, "surface", "left").select("reading", "surface", F.coalesce("c", F.lit(3000)).alias("cost"))
    return dictionary.merged(train_dictionary(tokens_of(spark, sf)), added)


@query(""", p as (select reading, surface, lead(reading) over (partition by k order by i) nx, b from t), q as (select reading || '*' || substr(nx,1,1) reading, surface from p where b >= 10 and length(nx) <= 3)
select reading, surface, count(*)::BIGINT n, (round(-100 * ln(count(*)::double / (select count(*) from t where b >= 10))) + 400)::INT as "cost" from q group by all having count(*) >= 10""", tokens=True)
def pair_lines(spark, sf):
    t = train(tokens_of(spark, sf, NEXT))
    p = t.filter(F.length("nx") <= 3)
    p = p.select(words.particle_line(F.col("reading"), F.col("surface"), F.col("nx")).alias("l")).select("l.*")
    return dictionary.pair_lines(p, t.agg(F.count("*").alias("total")), 10)


@query(_DICT2 + """, o as (select regexp_extract(reading, '^(.+)(ing|ed|en|er|ment|keit|ción|es)$', 1) stem, regexp_extract(reading, '^(.+)(ing|ed|en|er|ment|keit|ción|es)$', 2) suffix, "cost" from dict)
select stem || '*' || substr(suffix,1,1) reading, stem surface, min("cost")::INT as "cost" from o where stem <> '' group by all""", tokens=True)
def okuri_lines(spark, sf):
    pattern = "^(.+)(ing|ed|en|er|ment|keit|ción|es)$"
    d = train_dictionary(tokens_of(spark, sf)).select(F.regexp_extract("reading", pattern, 1).alias("stem"), F.regexp_extract("reading", pattern, 2).alias("suffix"), "cost").filter("stem <> ''")
    return dictionary.okuri_lines(d.select(F.concat("stem", F.lit("*"), F.substring("suffix", 1, 1)).alias("reading"), F.col("stem").alias("surface"), "cost"))


@query(""", base as (select reading, surface from t where b >= 10 and kind <> 'src1' group by all having count(*) >= 2), own as (select reading, surface, count(*)::BIGINT n from t where kind = 'src1' group by all having count(*) >= 2)
select own.* from own anti join base using (reading, surface)""", tokens=True)
def additional_keep(spark, sf):
    t = tokens_of(spark, sf)
    base = train(t).filter("kind <> 'src1'").groupBy("reading", "surface").agg(F.count("*").alias("n")).filter("n >= 2").select("reading", "surface")
    own = t.filter("kind = 'src1'").groupBy("reading", "surface").agg(F.count("*").alias("n")).filter("n >= 2")
    return dictionary.without(own, base, ["reading", "surface"])


@query(""", g as (select reading, surface, count(*) n from t group by all) select reading, surface, n::BIGINT n from (select *, row_number() over (partition by reading order by n desc, surface) rn from g) where rn = 1""", tokens=True)
def argmax_surface(spark, sf):
    n = tokens_of(spark, sf).groupBy("reading", "surface").agg(F.count("*").alias("n"))
    return chains.most_frequent(n, ["reading"], "surface")


@query(""", f as (select substr(reading,1,2) head, reading, surface, min(i) first_at from t group by all), r as (select head, reading, surface, row_number() over (partition by head order by first_at, reading, surface) - 1 rn from f)
select head, reading, surface, least(16383, 8192 + rn)::INT as "cost" from r""", tokens=True)
def list_cost(spark, sf):
    items = tokens_of(spark, sf).select(F.substring("reading", 1, 2).alias("head"), F.concat_ws(" ", "reading", "surface").alias("pair"), "i")
    out = dictionary.listed(items.select(F.col("head").alias("reading"), F.col("pair").alias("surface"), "i"), "i")
    return out.select(F.col("reading").alias("head"), F.substring_index("surface", " ", 1).alias("reading"), F.substring_index("surface", " ", -1).alias("surface"), "cost")


# ---- chains and neighbours -----------------------------------------------------------------------------------------


@query(""", c as (select k, reading p1, lead(reading) over (partition by k order by i) p2 from t) select p1, p2, count(*)::BIGINT n, count(distinct k)::BIGINT docs from c where p2 is not null group by all having count(*) >= 10 and count(distinct k) >= 5""", tokens=True)
def chain2(spark, sf):
    return chains.chains(units.readings(docs_of(spark, sf)), 2, 10, 5)


@query(""", c as (select k, reading p1, lead(reading) over (partition by k order by i) p2, lead(reading,2) over (partition by k order by i) p3 from t) select p1, p2, p3, count(*)::BIGINT n, count(distinct k)::BIGINT docs from c where p3 is not null group by all having count(*) >= 10 and count(distinct k) >= 5""", tokens=True)
def chain3(spark, sf):
    return chains.chains(units.readings(docs_of(spark, sf)), 3, 10, 5)


@query(""", nm as (select distinct lower(s) w from (select unnest(regexp_extract_all(text,'\\p{L}+')) s from benchmark) where length(s) >= 4),
 c as (select k, reading p1, lead(reading) over (partition by k order by i) p2 from t) select p1, p2, count(*)::BIGINT n from c semi join nm on c.p1 = nm.w where p2 in (select w from nm) group by all having count(*) >= 2""", tokens=True)
def chain_names(spark, sf):
    names = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(units.TOKEN), 1)).alias("w")).filter("length(w) >= 4").select(F.lower("w").alias("w")).distinct()
    c = tokens_of(spark, sf, units.ahead(2)).select(F.col("reading").alias("p1"), F.col("n2").alias("p2"))
    # Only pairs of names are counted: the others aren't shuffled.
    named = c.join(names, c["p1"] == names["w"], "left_semi").join(names.withColumnRenamed("w", "w2"), F.col("p2") == F.col("w2"), "left_semi")
    return named.groupBy("p1", "p2").agg(F.count("*").alias("n")).filter("n >= 2")


@query(""", x as (select reading, lag(reading) over (partition by k order by i) lf from t), c as (select reading, lf, count(*) n from x group by all), s as (select reading, sum(n) tot from c group by reading having sum(n) >= 50)
select reading, s.tot::BIGINT total, round(-sum(n / s.tot * log2(n / s.tot)), 6) + 0.0 entropy from c join s using (reading) group by all""", tokens=True)
def side_entropy(spark, sf):
    x = tokens_of(spark, sf, LAST).groupBy("reading", "lf").agg(F.count("*").alias("n"))
    return patterns.entropy(x, ["reading"]).filter("total >= 50").withColumn("entropy", F.round("entropy", 6))


@query(""", x as (select reading, lag(reading) over (partition by k order by i) lf from t) select reading, count(*)::BIGINT total, round(count(*) filter (lf is null or length(lf) <= 2) / count(*), 6) apart from x group by reading having count(*) >= 50""", tokens=True)
def apart_share(spark, sf):
    x = tokens_of(spark, sf, LAST).withColumnRenamed("lf", "ch")
    n = x.groupBy(F.col("reading").alias("pattern"), "ch").agg(F.count("*").alias("n")).withColumn("side", F.lit("before"))
    return chains.apart_share(n, F.length("ch") <= 2).filter("total >= 50").select(F.col("pattern").alias("reading"), "total", F.round("apart", 6).alias("apart"))


@query(""", u as (select reading, count(*) n from t group by all), c as (select reading p1, lead(reading) over (partition by k order by i) p2 from t), p as (select p1, p2, count(*) n from c where p2 is not null group by all having count(*) >= 5)
select p1, p2, p.n::BIGINT n, round(p.n / greatest(1, least(a.n, b.n)), 9) cohesion from p join u a on a.reading = p1 join u b on b.reading = p2""", tokens="once")
def cohesion(spark, sf):
    pairs = chains.chains(units.readings(docs_of(spark, sf)), 2, 5).select("p1", "p2", "n")
    return chains.cohesion(pairs, tokens_of(spark, sf).groupBy("reading").agg(F.count("*").alias("n"))).select("p1", "p2", "n", F.round("cohesion", 9).alias("cohesion"))


@query(""", c as (select k, i, i - row_number() over (partition by k order by i) g from t where regexp_matches(surface, '^\\p{Lu}')), r as (select k, g, min(i) s, max(i) + 1 e, count(*) n from c group by all)
select k, s::INT as "start", e::INT as "end", n::BIGINT n from r where n >= 2""", tokens=True)
def touching_runs(spark, sf):
    return units.runs(tokens_of(spark, sf), F.col("surface").rlike("^\\p{Lu}")).filter("n >= 2").select("k", "start", "end", "n")


# ---- spans ---------------------------------------------------------------------------------------------------------

_SPANS = """, x as (select *, lead(surface) over (partition by k order by i) s2, lead(reading) over (partition by k order by i) r2 from t),
 comp as (select k, i s, i + 2 e from x where length(surface) >= 6 and length(s2) >= 6),
 joined as (select k, kind, i s, i + 2 e, surface || ' ' || s2 surface, reading || ' ' || r2 reading, surface a, reading ra, s2 b2, r2 rb from x where length(surface) <= 3 and length(s2) >= 6),
 jin as (select j.*, exists(select 1 from comp c where c.k = j.k and c.s <= j.s and c.e >= j.e) inside from joined j),
 est as (select reading, surface, count(*) n from jin where not inside group by all having count(*) >= 2)
"""


def _spanned(t: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Units, compounds and joined units, with spans in token places."""
    x = t.withColumns({"start": F.col("i"), "end": F.col("i") + 1})
    compounds = x.filter("length(surface) >= 6 and length(s2) >= 6").select("k", "start", (F.col("start") + 2).alias("end"))
    joined = x.filter("length(surface) <= 3 and length(s2) >= 6").select(
        "k", "kind", "start", (F.col("start") + 2).alias("end"), F.concat_ws(" ", "surface", "s2").alias("surface"), F.concat_ws(" ", "reading", "r2").alias("reading"), F.col("surface").alias("a"), F.col("reading").alias("ra"), F.col("s2").alias("b2"), F.col("r2").alias("rb")
    )
    return x.select("k", "kind", "start", "end", "surface", "reading"), compounds, joined


@query(_SPANS + " select kind, count(*)::BIGINT units, count(*) filter (exists(select 1 from comp c where c.k = t.k and c.s <= t.i and c.e >= t.i + 1))::BIGINT inside from t group by kind", tokens=True)
def span_cover(spark, sf):
    u, compounds, _ = _spanned(tokens_of(spark, sf, SPANNED))
    return intervals.covered(u.select("k", "kind", "start", "end"), compounds).groupBy("kind").agg(F.count("*").alias("units"), F.count_if("inside").alias("inside"))


@query(_SPANS + """, m as (select k, kind, i s, i + 3 e from t t0 where i % 3 = 0 and exists(select 1 from t t1 where t1.k = t0.k and t1.i = t0.i + 2))
 select kind, count(*)::BIGINT units from m where not exists(select 1 from comp c where c.k = m.k and m.s < c.e and m.e > c.s and (m.s < c.s or m.e > c.e)) group by kind""", tokens=True)
def span_runout(spark, sf):
    t = tokens_of(spark, sf, SPANNED | {"later": ("surface", 2)})
    _, compounds, _ = _spanned(t)
    m = t.filter("i % 3 = 0 and later is not null").select("k", "kind", F.col("i").alias("start"), (F.col("i") + 3).alias("end"))
    return intervals.not_running_out(m, compounds).groupBy("kind").agg(F.count("*").alias("units"))


@query(_SPANS + """, u as (select surface, exists(select 1 from comp c where c.k = t.k and c.s <= t.i and c.e >= t.i + 1) inside from t)
 select surface, count(*) filter (inside)::BIGINT inside, count(*)::BIGINT places from u group by surface having count(*) filter (inside) * 4 >= count(*) * 3 and count(*) >= 2""", tokens=True)
def fragments(spark, sf):
    u, compounds, _ = _spanned(tokens_of(spark, sf, SPANNED))
    return dictionary.fragments(intervals.covered(u.select("k", "start", "end", "surface"), compounds), 2)


def _established(joined: DataFrame, compounds: DataFrame) -> DataFrame:
    outside = intervals.covered(joined, compounds).filter("not inside")
    return outside.groupBy("reading", "surface").agg(F.count("*").alias("n")).filter("n >= 2")


@query(_SPANS + " select reading, surface, n::BIGINT n from est", tokens=True)
def established(spark, sf):
    _, compounds, joined = _spanned(tokens_of(spark, sf, SPANNED))
    return _established(joined, compounds)


def _typed(joined: DataFrame, est: DataFrame, with_nouns: bool) -> DataFrame:
    """Each joined unit as it is typed: whole if established, else its parts; counted, an established one has its noun beside it."""
    rows = joined.join(est.select("reading", "surface", F.lit(True).alias("known")), ["reading", "surface"], "left")
    unit = lambda r, s: F.struct(F.col(r).alias("reading"), F.col(s).alias("surface"))
    whole, first, second = unit("reading", "surface"), unit("ra", "a"), unit("rb", "b2")
    return rows.select(F.explode(F.when(F.col("known"), F.array(whole, second) if with_nouns else F.array(whole)).otherwise(F.array(first, second))).alias("u")).select("u.*")


@query(_SPANS + """, y as (select j.*, est.n is not null known from jin j left join est using (reading, surface)),
 o as (select reading, surface from y where known union all select ra, a from y where not known union all select rb, b2 from y where not known) select reading, surface, count(*)::BIGINT n from o group by all having count(*) >= 3""", tokens=True)
def as_typed(spark, sf):
    _, compounds, joined = _spanned(tokens_of(spark, sf, SPANNED))
    return _typed(joined, _established(joined, compounds), False).groupBy("reading", "surface").agg(F.count("*").alias("n")).filter("n >= 3")


@query(_SPANS + """, y as (select j.*, est.n is not null known from jin j left join est using (reading, surface)),
 o as (select reading, surface from y where known union all select ra, a from y where not known union all select rb, b2 from y) select reading, surface, count(*)::BIGINT n from o group by all having count(*) >= 3""", tokens=True)
def as_counted(spark, sf):
    _, compounds, joined = _spanned(tokens_of(spark, sf, SPANNED))
    return _typed(joined, _established(joined, compounds), True).groupBy("reading", "surface").agg(F.count("*").alias("n")).filter("n >= 3")


# ---- patterns ------------------------------------------------------------------------------------------------------

@query(""", pat as (select distinct lower(w) pattern from (select unnest(regexp_extract_all(text, '\\p{L}+')) w from benchmark)), c as (select reading, count(*) n from t group by reading)
select pattern, coalesce(n, 0)::BIGINT n from pat left join c on c.reading = pat.pattern""", tokens=True)
def ngram_match(spark, sf):
    """How often each word of the benchmark, of any length, stands in the documents; as a run of letters with none beside it, it's a token there."""
    words = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(units.TOKEN), 0)).alias("w"))
    d = docs_of(spark, sf).select("k", F.lower("text").alias("text"))
    return patterns.word_counts(d, words.select(F.lower("w").alias("pattern")).distinct())


@query(""", n as (select reading, count(*) filter (substr(kind, 4)::INT >= 10) as nw, count(*) filter (substr(kind, 4)::INT < 10) old from t group by reading),
 c as (select sum(length(text)) filter (substr(source, 4)::INT >= 10) nc, sum(length(text)) filter (substr(source, 4)::INT < 10) oc from documents)
select reading, nw::BIGINT as "new", old::BIGINT "old" from n, c where nw / nc >= 3.0 * (old + 1) / oc""", tokens=True)
def novel_words(spark, sf):
    d = docs_of(spark, sf).withColumn("is_new", F.regexp_replace("kind", "^src", "").cast("int") >= 10)
    chars = d.agg(F.sum(F.when(F.col("is_new"), F.length("text"))).alias("new"), F.sum(F.when(~F.col("is_new"), F.length("text"))).alias("old")).first()  # two numbers
    t = units.tokens(d).withColumn("is_new", F.regexp_replace("kind", "^src", "").cast("int") >= 10)
    n = t.groupBy("reading").agg(F.count_if("is_new").alias("new"), F.count_if(~F.col("is_new")).alias("old"))
    return patterns.novel(n, chars["new"] or 0, chars["old"] or 0, 3.0)


@query(""", ti as (select distinct lower(s[1] || ' ' || s[2]) title from (select regexp_extract_all(text,'\\p{L}+') s from benchmark)), c as (select reading || ' ' || lead(reading) over (partition by k order by i) title from t)
select ti.title, count(c.title)::BIGINT n from ti left join c using (title) group by ti.title""", tokens=True)
def title_reads(spark, sf):
    s = F.regexp_extract_all("text", F.lit(units.TOKEN), 1)
    titles = table(spark, sf, "benchmark").select(F.lower(F.concat(F.get(s, 0), F.lit(" "), F.get(s, 1))).alias("title")).distinct()
    pairs = tokens_of(spark, sf, units.ahead(2)).select(F.concat("reading", F.lit(" "), "n2").alias("title"))
    # Only the places of titles are counted: other pairs, nearly all, aren't shuffled.
    c = pairs.join(titles, "title", "left_semi").groupBy("title").agg(F.count("*").alias("n"))
    return titles.join(c, "title", "left").select("title", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


# ---- evaluation ----------------------------------------------------------------------------------------------------


def _attempts(spark, sf, keys: list[str] | None = None, min_count: int = 2) -> DataFrame:
    t = tokens_of(spark, sf)
    return evaluate.attempts(held_out(t), train_dictionary(t, min_count), keys)


@query(_ATTEMPTS + keys_sql("at0", "reading") + ' select reading, units, missing, "first", best_first, best_first - "first" loss from kt', tokens=True)
def eval_loss(spark, sf):
    return evaluate.by_key(_attempts(spark, sf)).select("reading", "units", "missing", "first", "best_first", (F.col("best_first") - F.col("first")).alias("loss"))


@query(_ATTEMPTS + keys_sql("at0", "reading") + " select reading, page, best_page, best_page - page page_loss from kt", tokens=True)
def eval_page(spark, sf):
    return evaluate.by_key(_attempts(spark, sf)).select("reading", "page", "best_page", (F.col("best_page") - F.col("page")).alias("page_loss"))


@query(_ATTEMPTS + keys_sql("att", "kind, reading") + """, kt2 as (select kind, sum(units)::BIGINT units, sum(missing)::BIGINT missing, sum(best_first - "first")::BIGINT loss, sum(best_page - page)::BIGINT page_loss from kt group by kind),
 ks as (select distinct source kind from documents)""" + keys_sql("at0", "reading").replace("pl as", "pl9 as").replace("from pl ", "from pl9 ").replace("kt as", "kt9 as") + """
 select kind, coalesce(units,0)::BIGINT units, coalesce(missing,0)::BIGINT missing, coalesce(loss,0)::BIGINT loss, coalesce(page_loss,0)::BIGINT page_loss from ks left join kt2 using (kind)
 union all select 'all', coalesce(sum(units),0)::BIGINT, coalesce(sum(missing),0)::BIGINT, coalesce(sum(best_first - "first"),0)::BIGINT, coalesce(sum(best_page - page),0)::BIGINT from kt9""", tokens=True)
def eval_total(spark, sf):
    """Scores by kind, with rows for kinds without held-out documents, and for all: keys are tallied anew there, not summed over kinds."""
    by_kind = _attempts(spark, sf, ["kind"])
    kinds = table(spark, sf, "documents").select(F.col("source").alias("kind")).distinct()
    each = evaluate.scores(evaluate.by_key(by_kind, ["kind"]), ["kind"])
    values = ["units", "missing", "loss", "page_loss"]
    each = kinds.join(each, "kind", "left").na.fill(0, values)
    whole = by_kind.groupBy("reading", "surface").agg(F.sum("n").alias("n"), F.any_value("rank").alias("rank"))
    return each.unionByName(evaluate.scores(evaluate.by_key(whole), []).select(F.lit("all").alias("kind"), *values))


@query(_ATTEMPTS + """ select case when rank = 1 then 'first' when rank <= 9 then 'lower' when rank is not null then 'off page' when surface in (select surface from tr) then 'other reading' when reading in (select reading from tr) then 'other surfaces' else 'unseen' end reason, sum(n)::BIGINT n from at0 group by all""", tokens=True)
def loss_reasons(spark, sf):
    t = tokens_of(spark, sf)
    return evaluate.reasons(_attempts(spark, sf), train(t).select("reading", "surface").distinct())


@query(""", tr as (select * from t where b >= 10), g as (select reading, surface, count(*) n from tr group by all), ev as (select reading, count(*) filter (g.n >= 2) found2, count(*) filter (g.n >= 4) found4, count(*) units from t left join g using (reading, surface) where b between 1 and 9 group by reading)
select reading, (units - found2)::BIGINT missing_before, (units - found4)::BIGINT missing_after, (found2 - found4)::BIGINT missing_change from ev where found2 <> found4""", tokens=True)
def keys_diff(spark, sf):
    runs = [evaluate.by_key(_attempts(spark, sf, min_count=m)) for m in (2, 4)]
    return evaluate.diff(runs[0], runs[1], ["reading"], ["missing"])


@query(_DICT2 + """, cs as (select d.doc_id case_id, d.lang category, lower(s[1]) reading, s[1] surface from (select doc_id, lang, regexp_extract_all(text,'\\p{L}+') s from documents) d where len(s) > 0),
 res as (select cs.category, rk.rank from cs left join rk using (reading, surface))
 select coalesce(category, 'all') category, count(*)::BIGINT cases, count(*) filter (rank = 1)::BIGINT "first", count(*) filter (rank <= 9)::BIGINT page, count(*) filter (rank is null)::BIGINT missing from res group by rollup (category)""", tokens=True)
def word_scores(spark, sf):
    """Each document's first unit as a case of its language."""
    first = F.get(F.regexp_extract_all("text", F.lit(units.TOKEN), 1), 0)
    cases = table(spark, sf, "documents").select(F.col("doc_id").alias("case_id"), F.col("lang").alias("category"), first.alias("s")).filter("s is not null")
    cases = cases.select("case_id", "category", F.lower("s").alias("reading"), F.array("s").alias("accepted"))
    return evaluate.word_scores(evaluate.check_words(cases, train_dictionary(tokens_of(spark, sf))))


_STRATUM = """case when "cost" < 800 then 'common' when "cost" >= 1150 then 'rare' else 'middle' end"""


def _strata(spark, sf) -> DataFrame:
    d = train_dictionary(tokens_of(spark, sf))
    return d.withColumn("stratum", F.when(F.col("cost") < 800, "common").when(F.col("cost") >= 1150, "rare").otherwise("middle"))


@query(_DICT2 + f' select {_STRATUM} stratum, count(*)::BIGINT "lines", min("cost")::INT least, max("cost")::INT most from dict group by all', tokens=True)
def strata(spark, sf):
    return _strata(spark, sf).groupBy("stratum").agg(F.count("*").alias("lines"), F.min("cost").alias("least"), F.max("cost").alias("most"))


@query(_DICT2 + f""", l as (select {_STRATUM} stratum, reading || chr(9) || surface || chr(9) || "cost" line from dict) select stratum, line from (select *, row_number() over (partition by stratum order by sha256(line), line) rn from l) where rn <= 60""", tokens=True)
def hash_sample(spark, sf):
    return select.sample_by_hash(_strata(spark, sf), F.concat_ws("\t", "reading", "surface", F.col("cost").cast("string")), 60, ["stratum"]).select("stratum", "line")


@query(_DICT2 + """, p as (select reading, case when length(reading) > 3 and ends_with(reading, 's') then [substr(reading, 1, length(reading) - 1)] when length(reading) = 2 then [] else [reading] end paths from dict)
 select case when len(paths) = 0 then 'unread' when list_contains(paths, reading) then 'agrees' else 'disagrees' end agreement, count(*)::BIGINT n from p group by all""", tokens=True)
def agreement(spark, sf):
    """A second analyzer that drops a final s and can't read words of two letters."""
    r = F.col("reading")
    none = F.array().cast("array<string>")
    paths = F.when((F.length(r) > 3) & r.endswith("s"), F.array(F.substring(r, F.lit(1), F.length(r) - 1))).when(F.length(r) == 2, none).otherwise(F.array(r))
    d = train_dictionary(tokens_of(spark, sf))
    return d.groupBy(evaluate.agreement(r, paths).alias("agreement")).agg(F.count("*").alias("n"))


@query(""", g as (select surface, lower(surface) reading, count(*) n from t where regexp_matches(surface, '^\\p{Lu}') group by all having count(*) >= 5)
select surface label, g.reading expected, string_agg(distinct x.reading, ',' order by x.reading) offered from g join (select surface, substr(reading, 1, 4) reading from t) x using (surface) group by all having not list_contains(list(x.reading), g.reading)""", tokens=True)
def label_mismatch(spark, sf):
    """Capitalised words as labels, against a dictionary that reads only four letters of each."""
    t = tokens_of(spark, sf)
    labels = t.filter(F.col("surface").rlike("^\\p{Lu}")).groupBy("surface").agg(F.count("*").alias("n")).filter("n >= 5").select(F.col("surface").alias("label"), F.array(F.lower("surface")).alias("readings"))
    read = t.select("surface", F.substring("reading", 1, 4).alias("reading")).distinct()
    return evaluate.mismatches(labels, read).select("label", F.array_join("readings", ",").alias("expected"), F.array_join("offered", ",").alias("offered"))


_CORRECTIONS = ["the of", "de la", "der"]


@query("""with d as (select lower(array_to_string(regexp_extract_all(text,'\\p{L}+'), ' ')) x from documents), c(correction) as (values ('the of'), ('de la'), ('der'))
select correction, sum(len(string_split(replace(' ' || replace(x, ' ', '  ') || ' ', ' ' || replace(correction, ' ', '  ') || ' ', chr(1)), chr(1))) - 1)::BIGINT places, count(*) filter (contains(' ' || x || ' ', ' ' || correction || ' '))::BIGINT docs from c, d group by correction""")
def correction_uses(spark, sf):
    """How often each correction would apply, and in how many documents; one pass for all corrections of a short list."""
    d = table(spark, sf, "documents").select(F.lower(F.array_join(F.regexp_extract_all("text", F.lit(units.TOKEN), 1), " ")).alias("x"))
    wide = F.concat(F.lit(" "), F.replace("x", F.lit(" "), F.lit("  ")), F.lit(" "))

    def places(c: str):
        at = f" {c.replace(' ', '  ')} "
        return ((F.length(wide) - F.length(F.replace(wide, F.lit(at), F.lit("")))) / len(at)).cast("long")

    rows = d.select(F.explode(F.array(*[F.struct(F.lit(c).alias("correction"), places(c).alias("n")) for c in _CORRECTIONS])).alias("c")).select("c.*")
    return rows.groupBy("correction").agg(F.sum("n").alias("places"), F.count_if(F.col("n") > 0).alias("docs"))


# ---- lists on the star schema ----------------------------------------------------------------------------------------


@query("select p_name as name, max(l_extendedprice) weight, count(distinct l_suppkey)::BIGINT bearers from lineitem join part on p_partkey = l_partkey group by p_name having count(distinct l_suppkey) >= 2")
def bearers(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice").join(table(spark, sf, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return dictionary.bearers(rows.select(F.col("p_name").alias("name"), F.col("l_suppkey").alias("item"), F.col("l_extendedprice").alias("weight")))


@query("""with x as (select unnest(list_distinct([n_name, r_name])) as name from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey)
select name, count(*)::BIGINT n, round(-100 * ln(count(*)::double / (select count(*) from customer)))::INT as "cost" from x group by name""")
def row_share(spark, sf):
    c, n, r = (table(spark, sf, x) for x in ("customer", "nation", "region"))
    rows = c.select("c_nationkey").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return dictionary.shares(rows, F.array("n_name", "r_name"), c.agg(F.count("*").alias("total")))


@query("""with o as (select event_type, user_id, max(value) w from events group by all) select event_type, round(sum(w), 6) weight, count(*)::BIGINT users from o group by all""")
def weighted_sum(spark, sf):
    e = table(spark, sf, "events").select("event_type", "user_id", "value")
    n = e.groupBy("event_type", "user_id").agg(F.max("value").alias("w"))
    return n.groupBy("event_type").agg(F.round(F.sum("w"), 6).alias("weight"), F.count("*").alias("users"))


@query("""with c as (select p_type t, min(p_partkey % 500 + 100)::INT c from part group by 1), n(d, r) as (values ('1','one '),('2','two '),('3','three '),('4','four '),('5','five '),('6','six '),('7','seven '),('8','eight '),('9','nine '),('10','ten ')),
 w as (select '3' || t surface, 150 c from c) select r || lower(t) reading, d || t surface, least(c.c + 230, coalesce(w.c, c.c + 230))::INT as "cost" from c cross join n left join w on w.surface = d || t""")
def crosscount(spark, sf):
    counters = table(spark, sf, "part").groupBy(F.col("p_type").alias("surface")).agg(F.min(F.col("p_partkey") % 500 + 100).cast("int").alias("cost")).withColumn("reading", F.lower("surface"))
    names = "one two three four five six seven eight nine ten".split()
    numbers = spark.createDataFrame([(str(i + 1), f"{w} ") for i, w in enumerate(names)], "number string, number_reading string")
    written = counters.select(F.concat(F.lit("3"), "surface").alias("surface"), F.lit(150).alias("cost"))
    return dictionary.counted_words(counters, numbers, written)


@query(_DICT2 + """, w as (select reading word, "cost" c from (select reading, min("cost") as "cost" from dict where length(reading) between 4 and 8 group by reading)),
 a as (select word, c, x.way, substr(word, 1, x.way) h from w, lateral (select unnest(range(1, length(word)))::INT way) x) select h reading, round(sum(exp(-c / 100) / (length(word) - 1)), 9) weight from a group by h""", tokens=True)
def alignment_share(spark, sf):
    """Each word cut in two in all ways, its weight shared among them."""
    d = train_dictionary(tokens_of(spark, sf)).filter("length(reading) between 4 and 8").groupBy(F.col("reading").alias("word")).agg(F.min("cost").alias("cost"))
    ways = d.select("word", "cost", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("way"))
    heads = ways.select("word", "cost", "way", F.substring(F.col("word"), F.lit(1), F.col("way")).alias("reading"), F.lit("").alias("kanji"))
    return dictionary.alignment_shares(heads).select("reading", F.round("weight", 9).alias("weight"))


# ---- dictionary entries, reports and budgets -----------------------------------------------------------------------


@query(""", ti as (select distinct lower(w) surface from (select unnest(regexp_extract_all(text, '\\p{L}+')) w from benchmark) where length(w) >= 2)
select ti.surface reading, ti.surface, count(*)::BIGINT n, round(-100 * ln(count(*)::double / (select count(*) from t)))::INT as "cost" from t join ti on ti.surface = t.reading group by all having count(*) >= 2""", tokens="once")
def title_entries(spark, sf):
    """Words of the benchmark as titles: short ones counted as units, long ones as whole words of the texts."""
    t = tokens_of(spark, sf)
    titles = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(units.TOKEN), 1)).alias("surface")).filter("length(surface) >= 2").select(F.lower("surface").alias("surface")).distinct()
    as_units = t.groupBy(F.col("reading").alias("surface")).agg(F.count("*").alias("n")).filter("length(surface) < 9")
    long = titles.filter("length(surface) >= 9").select(F.col("surface").alias("pattern"))
    in_texts = patterns.word_counts(docs_of(spark, sf).select("k", F.lower("text").alias("text")), long).withColumnRenamed("pattern", "surface")
    return dictionary.title_entries(titles.withColumn("reading", F.col("surface")), as_units, in_texts, t.agg(F.count("*").alias("total")))


_NUMBERED = """with u as (select '{}' || lower(m) reading, '{half}' || m surface from (select unnest(regexp_extract_all(text, '[0-9]+ ([a-z]\\p{L}*)', 1)) m from documents))"""


def _numbered(spark, sf) -> DataFrame:
    found = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[0-9]+ ([a-z]\\p{L}*)"), 1)).alias("m"))
    return found.select(F.concat(F.lit("{}"), F.lower("m")).alias("reading"), F.concat(F.lit("{half}"), "m").alias("surface"))


@query(_NUMBERED + """ select reading, surface, round(-100 * ln(count(*)::double / (select count(*) from u)))::INT as "cost" from u group by all having count(*) >= 2""")
def numeric_entries(spark, sf):
    u = _numbered(spark, sf)
    return dictionary.numeric_entries(u, u.agg(F.count("*").alias("total")), F.lit(False))


@query(_NUMBERED + """, e as (select distinct reading, surface from u) select * from e where substr(reading, 3) not in (select lower(w) from (select unnest(regexp_extract_all(text, '\\p{L}+')) w from benchmark))""")
def small_number_items(spark, sf):
    nouns = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(units.TOKEN), 1)).alias("w")).select(F.lower("w").alias("w")).distinct()
    numeric = _numbered(spark, sf).distinct()
    by_nouns = numeric.join(nouns, F.col("w") == F.substr("reading", F.lit(3)), "left_semi")
    return dictionary.counting_small_numbers(numeric, by_nouns)


@query("""select doc_id, 'label' as origin, quality::INT as "value" from labels union all select doc_id, 'document', 0 from documents where doc_id not in (select doc_id from labels)""")
def preferred_union(spark, sf):
    first = table(spark, sf, "labels").select("doc_id", F.lit("label").alias("origin"), F.col("quality").cast("int").alias("value"))
    second = table(spark, sf, "documents").select("doc_id", F.lit("document").alias("origin"), F.lit(0).alias("value"))
    return dictionary.preferred(first, second, ["doc_id"])


@query(""" select reading, count(*)::BIGINT n, arg_min(surface, (k, i)) example from t group by reading""", tokens="once")
def first_examples(spark, sf):
    return dictionary.first_examples(tokens_of(spark, sf), ["reading"], F.struct("k", "i"), F.col("surface"))


@query(""", f as (select distinct surface, reading from t), s as (select distinct w surface, lower(w) reading from (select unnest(regexp_extract_all(text, '\\p{L}+')) w from conversations)) select surface, reading from f join s using (surface, reading)""", tokens=True)
def agreed_readings(spark, sf):
    other = table(spark, sf, "conversations").select(F.explode(F.regexp_extract_all("text", F.lit(units.TOKEN), 1)).alias("surface")).withColumn("reading", F.lower("surface"))
    return evaluate.agreed_readings(tokens_of(spark, sf), other)


@query(""" select kind, count(*)::BIGINT n, round(100 * count(*)::double / (select count(*) from t), 2) percent from t group by kind""", tokens="once")
def kind_percent(spark, sf):
    return evaluate.shares_of_total(tokens_of(spark, sf).groupBy("kind", "reading").agg(F.count("*").alias("n")), ["kind"])


@query(""" select reading surface, array_to_string(list_sort(list(distinct surface)), ' ') readings from t group by reading""", tokens=True)
def readings_by_surface(spark, sf):
    lines = tokens_of(spark, sf).select(F.col("reading").alias("surface"), F.col("surface").alias("reading"))
    return dictionary.readings_by_surface(lines).select("surface", F.array_join("readings", " ").alias("readings"))


@query("""with b as (select lower(w) surface, list_sort(list(distinct w)) r from (select unnest(regexp_extract_all(text, '\\p{L}+')) w from benchmark) group by 1),
 c as (select lower(w) surface, list_sort(list(distinct w)) r from (select unnest(regexp_extract_all(text, '\\p{L}+')) w from conversations) group by 1)
select surface, array_to_string(list_concat(coalesce(b.r, []), [x for x in coalesce(c.r, []) if not list_contains(coalesce(b.r, []), x)]), ' ') readings from b full join c using (surface)""")
def readings_after(spark, sf):
    def of(name: str) -> DataFrame:
        w = table(spark, sf, name).select(F.explode(F.regexp_extract_all("text", F.lit(units.TOKEN), 1)).alias("reading"))
        return dictionary.readings_by_surface(w.withColumn("surface", F.lower("reading")))

    return dictionary.readings_after(of("benchmark"), of("conversations")).select("surface", F.array_join("readings", " ").alias("readings"))


@query(""", w as (select 'word' kind, count(*)::BIGINT n, reading, surface from t group by reading, surface having count(*) >= 5), r as (select 'rare' kind, count(*)::BIGINT n, reading, surface from t group by reading, surface having count(*) < 5 and count(*) >= 3), a as (select * from w union all select * from r)
select kind, n, concat_ws(chr(9), kind, n::varchar, reading, surface) line from a""", tokens="once")
def report_lines(spark, sf):
    n = tokens_of(spark, sf).groupBy("reading", "surface").agg(F.count("*").alias("n"))
    return dictionary.report(word=n.filter("n >= 5"), rare=n.filter("n between 3 and 4")).select("kind", "n", "line")


@query(_SPANS + """ select kind, count(*)::BIGINT units from t where not exists(select 1 from comp c where c.k = t.k and c.s <= t.i and c.e >= t.i + 1) group by kind""", tokens=True)
def typed_units(spark, sf):
    u, compounds, _ = _spanned(tokens_of(spark, sf, SPANNED))
    return units.typed_units(u.select("k", "kind", "start", "end"), compounds).groupBy("kind").agg(F.count("*").alias("units"))


@query(_SPANS + """, cs as (select k, i, surface || ' ' || s2 surface from x where length(surface) >= 6 and length(s2) >= 6), un as (select k, i, surface || ' ' || s2 surface from x where surface ~ '^\\p{Lu}') select k, count(*)::BIGINT n from cs where not exists(select 1 from un where un.k = cs.k and un.i = cs.i and un.surface = cs.surface) group by k""", tokens=True)
def compound_units(spark, sf):
    """Compounds of two long words but those that start with a capital, which stand for units that are there already."""
    t = tokens_of(spark, sf, SPANNED).filter("s2 is not null").select("k", F.col("i").alias("start"), F.concat_ws(" ", "surface", "s2").alias("surface"), F.length("surface").alias("a"), F.length("s2").alias("b"))
    known = t.filter(F.col("surface").rlike("^\\p{Lu}"))
    return units.compound_units(t, known, F.expr("a >= 6 and b >= 6")).groupBy("k").agg(F.count("*").alias("n"))


@query(""", u as (select k, kind, count(*) n from t group by all), d2 as (select concat_ws(':', source, doc_id::varchar) k, source, doc_id from documents), b as (select d2.k, source, doc_id, coalesce(n, 0) n, coalesce(sum(coalesce(n, 0)) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0) before from d2 left join u using (k))
select k, source, n::BIGINT n, before::BIGINT "before" from b where before < 3000""", tokens="once")
def field_budget(spark, sf):
    """Documents of each source in order until 3,000 units are taken."""
    d = table(spark, sf, "documents").select(F.concat_ws(":", "source", "doc_id").alias("k"), "source", "doc_id", F.coalesce(F.size(F.regexp_extract_all("text", F.lit(units.TOKEN), 1)), F.lit(0)).cast("long").alias("n"))
    return select.field_budget(d, "source", "doc_id", F.col("n"), 3000, 64).select("k", "source", "n", "before")


@query("""with m as (select doc_id, (doc_id::HUGEINT * 11400714819323198485::HUGEINT) % 18446744073709551616::HUGEINT x from documents)
select doc_id, ((x % 140737488355328::HUGEINT * 131072 + x // 140737488355328::HUGEINT) // 4294967296)::BIGINT high from m""")
def shuffle_order(spark, sf):
    """The upper half of the number by which documents stand in a fixed pseudo-random order."""
    d = table(spark, sf, "documents").select("doc_id", select.shuffle_key(F.col("doc_id")).alias("x"))
    return d.select("doc_id", F.floor(F.col("x") / 4294967296).cast("long").alias("high"))


@query("""with y as (select distinct year(ts)::INT y from events) select y as "year", d::DATE as "day" from y, lateral (select unnest(range(make_date(y, 1, 1)::TIMESTAMP, make_date(y + 1, 1, 1)::TIMESTAMP, interval 1 day)) d) u""")
def days_of_years(spark, sf):
    years = table(spark, sf, "events").select(F.year("ts").alias("year")).distinct()
    return years.select("year", F.explode(documents.days_of(F.col("year"))).alias("day"))
