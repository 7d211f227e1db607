"""Line dedup by a log-template tree.

A line is its tokens between spaces; every line that has one is taken in.  The
tree has a fixed depth: number of tokens, then the LEAD leading tokens, where
tokens with a digit count as variable.  Under a leaf, a word is a constant at its
place if at least MIN_TEXTS occurrences there have it (a line counted once for
each different text that holds it), a token with a digit if over half of the leaf's
occurrences have it there; other places are variable fields.

A line's templates are

* if it has at most LEAD tokens, so also without spaces: its tokens as they are;
* the line itself, whatever its digits;
* its masked form, if at least MASKED_SHARE of its tokens have no digit;
* for each support that its constants have, those with at least that support, so that
  values of a field may pass MIN_TEXTS in a large corpus and still be told from the words around
  it.  At least SHARE of the tokens have to be constant, and half of those after the lead.

A template recurs if at least MIN_TEXTS occurrences follow it; a line of LONG
tokens or more recurs unchanged from LONG_TEXTS texts on, where chance is out of the question.  Lines
of a recurring template are dropped, but for its first one in (doc_id, text hash,
line) order, so that nothing vanishes from the corpus.  Exact copies of a
document count as one text, so a group of copies makes no template by itself.

Only SQL functions are used.  A hot leaf or line is pre-aggregated before every
shuffle and only ever joined, never windowed or collected.

Defined cases: texts and lines of any length are read whole; null text stays null (no lines); a text whose lines all go
becomes empty; untouched texts stay byte for byte; repeated rows (same doc_id
and text) are treated alike; null doc_ids come first; an empty table gives no
rows; columns of the input stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, free, saved

LEAD = 3
MIN_TEXTS = 10
LONG = 50
LONG_TEXTS = 3
SHARE = 0.75
MASKED_SHARE = 0.5
_VARIABLE = "<*>"


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(_VARIABLE)).otherwise(token)


def parsed(docs: DataFrame, key: str, text: str, lead: int = LEAD) -> DataFrame:
    """A row for each line that has a token: d, h (the document), no, line, tokens, leaf, hash."""
    lines = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("d"), F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n", -1)).alias("no", "line"))
    lines = lines.withColumn("tokens", F.filter(F.split("line", " ", -1), lambda x: x != "")).where(F.size("tokens") > 0)
    short = F.size("tokens") <= lead
    leading = [F.when(short, F.get("tokens", F.lit(i))).otherwise(_masked(F.get("tokens", F.lit(i)))) for i in range(lead)]
    return lines.withColumn("size", F.size("tokens")).withColumn("leaf", F.xxhash64("size", *leading)).withColumn("hash", F.xxhash64("line"))


def _least(size: Column, min_texts: int) -> Column:
    """In how many texts a line of ``size`` tokens has to stand unchanged."""
    return F.when(size >= LONG, F.least(F.lit(min_texts), F.lit(LONG_TEXTS))).otherwise(F.lit(min_texts))


def _kinds(lines: DataFrame, places: DataFrame, min_texts: int) -> DataFrame:
    """leaf, hash, texts (how many hold the line), first (struct d, h, no), line, tokens of each line in a leaf that may recur."""
    leaves = places.select("leaf", "h", "size").distinct().groupBy("leaf", "size").count()
    leaves = leaves.where(F.col("count") >= _least(F.col("size"), min_texts)).select("leaf")
    leaves = saved(leaves, "leaves")
    per_text = (lines.join(leaves, "leaf", "left_semi").groupBy("leaf", "hash", "h")
                .agg(F.min(F.struct("d", "no")).alias("at"), F.min("line").alias("line")))
    kinds = per_text.groupBy("leaf", "hash").agg(
        F.count("*").alias("texts"), F.min(F.struct(F.col("at.d").alias("d"), F.col("h"), F.col("at.no").alias("no"))).alias("first"),
        F.min("line").alias("line"))
    return saved(kinds, "lines").withColumn("tokens", F.filter(F.split("line", " ", -1), lambda x: x != ""))


def _nested(constants: Column, least: Column) -> Column:
    """A digest of each set of at least ``least`` (one or more) constants that are all those from some support on;
    ``constants`` (struct n, pos, code) from the most frequent to the least."""
    sums = F.aggregate(constants, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(x["code"]))))
    # A one-element array binds a value, so that it is computed once.
    return F.flatten(F.transform(F.array(F.struct(constants.alias("all"), sums.alias("sums"))), lambda p: F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size(p["all"]), F.lit(1))), lambda j: (j >= least) & (j <= F.size(p["all"])) & (
            (j == F.size(p["all"])) | (F.get(p["all"], j - 1)["n"] > F.get(p["all"], j)["n"]))),
        lambda j: F.xxhash64(F.get(p["sums"], j), j))))


def recurring(lines: DataFrame, places: DataFrame, min_texts: int = MIN_TEXTS, share: float = SHARE, lead: int = LEAD) -> DataFrame:
    """leaf, hash of every line that follows a recurring template, and the earliest first place (struct d, h, no) of its recurring templates;
    ``places`` are the lines without their text."""
    kinds = _kinds(lines, places, min_texts)
    digit = _masked(F.col("token")) == _VARIABLE
    fields = (kinds.select("leaf", "hash", "texts", F.size("tokens").alias("size"), F.posexplode("tokens").alias("pos", "token"))
              .where((F.col("size") > lead) & ((F.col("pos") >= lead) | digit)))
    constants = saved(fields.groupBy("leaf", "pos", "token").agg(F.sum("texts").alias("n")).where(F.col("n") >= min_texts), "constants")
    totals = kinds.groupBy("leaf").agg(F.sum("texts").alias("of"))
    # At most one value is dominant at a place.
    dominant = (constants.where(digit).groupBy("leaf", "pos").agg(F.max(F.struct("n", "token")).alias("top"))
                .join(totals, "leaf").where(F.col("top.n") * 2 > F.col("of")).select("leaf", "pos", "top.token", "top.n"))
    constants = constants.where(~digit).union(dominant).withColumn("code", F.xxhash64("pos", "token")).withColumn("digit", digit)
    kept = (fields.select("leaf", "hash", "pos", "token").join(constants, ["leaf", "pos", "token"]).groupBy("leaf", "hash")
            .agg(F.sort_array(F.collect_list(F.struct("n", "pos", "code", "digit")), False).alias("constants")))
    size, masked = F.size("tokens"), F.transform("tokens", _masked)
    words = F.filter("constants", lambda x: ~x["digit"])
    digits_leading = F.size(F.filter("constants", lambda x: x["pos"] < lead))
    leading = F.size(F.filter(F.slice("tokens", 1, lead), lambda x: _masked(x) != _VARIABLE))
    rest = F.ceil((size - lead) / 2)
    least = F.greatest(F.ceil(share * size - leading), rest, F.lit(1)).cast("int")
    least_mixed = F.greatest(F.ceil(share * size - leading), rest + digits_leading, F.lit(1)).cast("int")
    mixed = F.when(F.exists("constants", lambda x: x["digit"]), _nested(F.col("constants"), least_mixed))
    none = F.array().cast("array<bigint>")
    same = F.when(F.size(F.filter(masked, lambda x: x != _VARIABLE)) >= MASKED_SHARE * size, F.array(F.xxhash64(F.lit("masked"), masked)))
    known = F.concat(*(F.coalesce(x, none) for x in (same, _nested(words, least), mixed)))
    unchanged = F.struct(F.xxhash64(F.lit("line"), "hash").alias("id"), _least(size, min_texts).alias("least"))
    others = F.transform(F.array_distinct(known), lambda x: F.struct(x.alias("id"), F.lit(min_texts).alias("least")))
    short = F.array(F.struct(F.col("leaf").alias("id"), F.lit(min_texts).alias("least")))
    follows = (kinds.join(kept, ["leaf", "hash"], "left")
               .select("leaf", "hash", "texts", "first", F.explode(F.when(size <= lead, short).otherwise(F.concat(F.array(unchanged), others))).alias("t"))
               .select("leaf", "hash", "texts", "first", F.col("t.id").alias("template"), "t.least"))
    follows = saved(follows, "follows")
    templates = (follows.groupBy("leaf", "template").agg(F.sum("texts").alias("n"), F.min("least").alias("least"), F.min("first").alias("first"))
                 .where(F.col("n") >= F.col("least")).drop("n", "least"))
    return follows.select("leaf", "hash", "template").join(templates, ["leaf", "template"]).groupBy("leaf", "hash").agg(F.min("first").alias("first"))


def drop_templates(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str | None = None, dropped: str | None = None,
                   min_texts: int = MIN_TEXTS) -> DataFrame:
    """docs with the lines of recurring templates taken out of ``text`` (or put into ``out``);
    ``dropped``: a column with the number of lines taken out."""
    lines = parsed(docs, key, text)
    places = saved(lines.select("d", "h", "no", "leaf", "hash", "size"), "places")  # parsed once; narrow
    known = saved(recurring(lines, places, min_texts), "templates")
    here = F.struct("d", "h", "no")
    gone = (places.join(known, ["leaf", "hash"]).where(~here.eqNullSafe(F.col("first")))
            .groupBy("d", "h").agg(F.collect_set("no").alias("gone")))
    own, d, h, g = (free(docs, x) for x in ("own", "line_d", "line_h", "line_g"))
    gone = gone.select(F.col("d").alias(d), F.col("h").alias(h), F.col("gone").alias(g))
    joined = docs.withColumn(own, F.xxhash64(text)).join(gone, (F.col(own) == F.col(h)) & F.col(key).eqNullSafe(F.col(d)), "left")
    pair = F.array(F.struct(F.split(text, "\n", -1).alias("all"), F.col(g).alias("gone")))
    rest = F.transform(pair, lambda p: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(p["all"]) - 1), p["gone"]), lambda i: F.get(p["all"], i)), "\n"))[0]
    joined = joined.withColumn(out or text, F.when(F.col(g).isNull(), F.col(text)).otherwise(rest))
    if dropped:
        joined = joined.withColumn(dropped, F.coalesce(F.when(F.size(g) > 0, F.size(g)), F.lit(0)).cast("long"))
    return joined.drop(own, d, h, g)


def op4_lines(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = drop_templates(docs, out="kept", dropped="n_dropped")
    return out.select("doc_id", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"), "n_dropped",
                      F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = f"""
with t as (
  select doc_id, text, md5(text) as h, string_split(text, chr(10)) as body from documents
), l as (
  select doc_id, h, unnest(range(len(body))) as no, unnest(body) as line from t where text is not null
), k as (
  select *, list_filter(string_split(line, ' '), lambda x: x <> '') as tokens from l
), m as (
  select *, len(tokens) as size, list_transform(tokens, lambda x: case when regexp_matches(x, '[0-9]') then '{_VARIABLE}' else x end) as masked
  from k where len(tokens) > 0
), p as (
  select *, size::varchar || ' ' || array_to_string(case when size <= {LEAD} then tokens else masked[1:{LEAD}] end, ' ') as leaf,
         case when size >= {LONG} then {LONG_TEXTS} else {MIN_TEXTS} end as unchanged_least
  from m
), v as (
  select leaf from p group by leaf having count(distinct h) >= any_value(unchanged_least)
), u as (
  select leaf, line, any_value(size) as size, any_value(tokens) as tokens, any_value(masked) as masked, any_value(unchanged_least) as unchanged_least,
         count(distinct h) as texts, min([coalesce(doc_id, -1), no]) as spot
  from p where leaf in (select leaf from v) group by leaf, line
), f as (
  select leaf, line, size, texts, unnest(range(size)) as pos, unnest(tokens) as token from u where size > {LEAD}
), c as (
  select leaf, pos, token, sum(texts) as n, regexp_matches(token, '[0-9]') as digit from f group by leaf, pos, token having n >= {MIN_TEXTS}
), totals as (
  select leaf, sum(texts) as total from u group by leaf
), constants as (
  select leaf, pos, token, n, digit from c where not digit and pos >= {LEAD}
  union all
  select leaf, pos, token, n, digit from c join totals using (leaf) where digit and 2 * n > total
), held as (
  select leaf, line, size, pos, token, n, digit from f join constants using (leaf, pos, token)
), room as (  -- how many constants a line's template needs at least, with and without digits
  select leaf, line, ceil({SHARE} * size - len(list_filter(masked[1:{LEAD}], lambda x: x <> '{_VARIABLE}'))) as by_share, ceil((size - {LEAD}) / 2.0) as by_rest,
         coalesce((select count(*) from held h where h.leaf = u.leaf and h.line = u.line and h.pos < {LEAD}), 0) as digits_leading
  from u where size > {LEAD}
), nested as (  -- the constants from each support on: words alone, and with digits where there are any
  select s.leaf, s.line, list(h.pos::varchar || ':' || h.token order by h.pos) as chosen, false as mixed
  from (select distinct leaf, line, n from held where not digit) s join held h on h.leaf = s.leaf and h.line = s.line and h.n >= s.n and not h.digit
  group by s.leaf, s.line, s.n
  union all
  select s.leaf, s.line, list(h.pos::varchar || ':' || h.token order by h.pos), true
  from (select distinct leaf, line, n from held) s join held h on h.leaf = s.leaf and h.line = s.line and h.n >= s.n
  where exists (from held d where d.leaf = s.leaf and d.line = s.line and d.digit)
  group by s.leaf, s.line, s.n
), follows as (
  select leaf, line, 'short' as template, {MIN_TEXTS} as least from u where size <= {LEAD}
  union all
  select leaf, line, 'line ' || line, unchanged_least from u where size > {LEAD}
  union all
  select leaf, line, 'masked ' || array_to_string(masked, ' '), {MIN_TEXTS} from u
  where size > {LEAD} and len(list_filter(masked, lambda x: x <> '{_VARIABLE}')) >= {MASKED_SHARE} * size
  union
  select leaf, line, 'nested ' || array_to_string(chosen, ' '), {MIN_TEXTS} from nested join room using (leaf, line)
  where len(chosen) >= greatest(by_share, by_rest + case when mixed then digits_leading else 0 end, 1)
), z as (
  select leaf, template, min(spot) as spot from follows join u using (leaf, line) group by leaf, template having sum(texts) >= min(least)
), w as (
  select leaf, line, min(z.spot) as spot from follows join z using (leaf, template) group by leaf, line
), g as (
  select p.doc_id, p.h, p.no from p join w using (leaf, line) where [coalesce(p.doc_id, -1), p.no] <> w.spot
), x as (
  select doc_id, h, list(no) as gone from g group by all
)
select t.doc_id, coalesce(len(t.body), 0)::bigint as n_lines, coalesce(len(x.gone), 0)::bigint as n_dropped,
       sha256(coalesce(case when x.gone is null then t.text else
         array_to_string(list_transform(list_filter(range(len(t.body)), lambda i: not list_contains(x.gone, i)), lambda i: t.body[i + 1]), chr(10)) end, '')) as kept_sha256
from t left join x on x.doc_id is not distinct from t.doc_id and x.h = t.h
"""
