"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text splits losslessly into paragraphs (at line feeds); SECTION paragraphs
make a section.  A paragraph's digest is the md5 of its text, a section's the
md5 of its paragraphs' digests, the root the sha256 of the sections' digests:
equal texts have equal roots, and texts that differ have different ones.
Differing branches locate an edit: only sections whose digests differ are
opened (:func:`differing`).  Below a paragraph, pieces of PIECE words have short
digests, so that trees also tell how much of two texts is alike.

A fingerprint is ``root.sections.paragraphs.pieces``: the root in full, for the
rest the first 8 hex digits of each digest (pieces separated by spaces).

Likeness of two fingerprints: 1 if the roots are equal, else the share of the
larger set of distinct piece digests that both have.

Everything is built from SQL functions.  Defined cases: null text counts as
empty (one empty paragraph, one empty piece); texts of any length are used
whole; columns of the input stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, free, numbered, saved

SECTION = 8
PIECE = 4
_SHORT = 8


def _groups(items: Column, size: int, digest) -> Column:
    """digest of each run of ``size`` items (never empty)."""
    starts = F.sequence(F.lit(0), F.size(items) - 1, F.lit(size))
    return F.transform(starts, lambda i: digest(F.slice(items, i + 1, F.lit(size))))


def tree(text: Column) -> Column:
    """struct(root, sections, paragraphs, pieces) of a non-null text."""
    paragraphs = F.split(text, "\n", -1)
    # A one-element array binds a value, so that it is computed once.
    leaves = F.transform(paragraphs, F.md5)
    upper = F.transform(F.array(leaves), lambda p: F.struct(p.alias("p"), _groups(p, SECTION, lambda x: F.md5(F.array_join(x, ""))).alias("s")))
    pieces = F.flatten(F.transform(F.transform(paragraphs, lambda p: F.split(p, " ", -1)), lambda words: _groups(
        words, PIECE, lambda x: F.substring(F.md5(F.array_join(x, " ")), 1, _SHORT))))
    return F.transform(upper, lambda u: F.struct(
        F.sha2(F.array_join(u["s"], ""), 256).alias("root"), u["s"].alias("sections"), u["p"].alias("paragraphs"), pieces.alias("pieces")))[0]


def as_text(node: Column) -> Column:
    """A tree as a fingerprint."""
    short = lambda items: F.array_join(F.transform(items, lambda d: F.substring(d, 1, _SHORT)), "")
    return F.concat_ws(".", node["root"], short(node["sections"]), short(node["paragraphs"]), F.array_join(node["pieces"], " "))


def codes(pieces: Column) -> Column:
    """The pieces' digests as int numbers: half the room and cheaper to compare."""
    return F.transform(pieces, lambda p: (F.conv(p, 16, 10).cast("long") - (1 << 31)).cast("int"))


def likeness(a: Column, b: Column, a_pieces: Column, b_pieces: Column) -> Column:
    """Of two roots and their pieces (digests or codes), from 0 to 1."""
    shared = F.size(F.array_intersect(a_pieces, b_pieces)).cast("double")
    return F.when(a == b, F.lit(1.0)).otherwise(shared / F.greatest(F.size(F.array_distinct(a_pieces)), F.size(F.array_distinct(b_pieces))))


def differing(a: Column, b: Column) -> Column:
    """Positions (from 0) of the paragraphs of tree a that tree b has otherwise, found section by section."""
    sections = F.filter(F.sequence(F.lit(0), F.size(a["sections"]) - 1),
                        lambda i: ~F.get(a["sections"], i).eqNullSafe(F.get(b["sections"], i)))
    inside = F.flatten(F.transform(sections, lambda i: F.sequence(i * SECTION, F.least(i * SECTION + SECTION, F.size(a["paragraphs"])) - 1)))
    return F.filter(inside, lambda i: ~F.get(a["paragraphs"], i).eqNullSafe(F.get(b["paragraphs"], i)))


def fingerprints(docs: DataFrame, text: str, out: str = "fingerprint") -> DataFrame:
    """docs with the fingerprint of each whole text."""
    node = free(docs, "tree")
    return docs.withColumn(node, tree(F.coalesce(text, F.lit("")))).withColumn(out, as_text(F.col(node))).drop(node)


def with_next_head(docs: DataFrame, key: str, text: str, head: str, after: str) -> DataFrame:
    """key, text (null: empty), with ``head``, the first floor(length/4) characters
    of the next row's text in key order (after the last: the first), and
    ``after``, that row's root and piece codes.

    Only keys and lengths are put in order; a text is shuffled once, by its
    key, and the next row's head is sent to where the row before it lies.
    Equal keys follow a hash of their text; repeated rows are one row with a
    count until the end, where each is followed by its like and the last by
    the next.
    """
    rows = docs.select(F.coalesce(F.col(key), F.lit(0)).cast("long").alias("k"), F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64(F.col("key").isNull(), "text"))
    places = rows.select("k", "tie", "key", F.length("text").alias("n")).groupBy("k", "tie").agg(F.first("key").alias("key"), F.first("n").alias("n"))
    places = saved(numbered(places, [F.col("key").asc_nulls_first(), F.col("tie").asc()], "places", "row_no"), "numbered")
    total = max(1, places.count())  # one number
    before = places.select(F.pmod(F.col("row_no") + 1, F.lit(total)).alias("row_no"), F.col("k").alias("pk"), F.col("tie").alias("pt"),
                           F.floor(F.col("n") / 4).cast("int").alias("wanted"))
    links = places.select("k", "tie", "row_no").join(before, "row_no").drop("row_no")
    rows = rows.groupBy("k", "tie").agg(F.first("key").alias("key"), F.first("text").alias("text"), F.count("*").alias("times"))
    print_of = lambda t: F.struct(t["root"].alias("root"), codes(t["pieces"]).alias("codes"))
    # Always true; it needs every column that the rows below need, so that Spark reuses the one shuffle of the texts.
    same_columns = (F.col("times") > 0) & (F.col("key").isNull() | (F.col("key") == F.col("k")))
    given = rows.where(same_columns).join(links, ["k", "tie"]).select(
        F.col("pk").alias("k"), F.col("pt").alias("tie"), F.expr("substring(text, 1, wanted)").alias("head"), tree(F.col("text")).alias("t"))
    given = given.select("k", "tie", "head", print_of(F.col("t")).alias("after"))
    met = rows.join(given, ["k", "tie"]).select("key", "text", "head", "after", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth"), "times")
    like = F.col("nth") < F.col("times")  # a repeated row comes next
    own_head = F.expr("substring(text, 1, cast(floor(length(text) / 4) as int))")
    return met.select("key", "text", F.when(like, own_head).otherwise(F.col("head")).alias(head),
                      F.when(like, print_of(tree(F.col("text")))).otherwise(F.col("after")).alias(after))


def op10_merkle(spark, sf_dir: str) -> DataFrame:
    docs = with_next_head(documents(spark, sf_dir), "doc_id", "text", "head", "after")
    n = F.length("text")
    kept = F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))")
    docs = docs.select(F.col("key").alias("doc_id"), n.cast("long").alias("n_chars"), "text", F.concat(kept, "head").alias("edited"), "after")
    docs = docs.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), tree(F.col("text")).alias("own"),
                       tree(F.col("edited")).alias("new"), "after")
    docs = docs.select("*", codes(F.col("own.pieces")).alias("a"), codes(F.col("new.pieces")).alias("b"))
    own, new, after = F.col("own"), F.col("new"), F.col("after")
    return docs.select(
        "doc_id", "n_chars", "edited_sha256", as_text(own).alias("fingerprint"), as_text(new).alias("edited_fingerprint"),
        likeness(own["root"], new["root"], F.col("a"), F.col("b")).alias("near_edited"),
        likeness(own["root"], after["root"], F.col("a"), after["codes"]).alias("near_next"))


OP10_SQL = f"""
with d as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, ''))::bigint as n_chars from documents
), o as (
  select *, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id)) as next_text from d
), e as (
  select *, left(text, n_chars - n_chars // 4) || left(next_text, n_chars // 4) as edited from o
), u as (
  select doc_id, 'own' as kind, text as body from e
  union all select doc_id, 'new', edited from e
  union all select doc_id, 'next', next_text from e
), p as (
  select doc_id, kind, string_split(body, chr(10)) as paragraphs from u
), h as (
  select doc_id, kind, list_transform(paragraphs, lambda x: md5(x)) as leaves,
         flatten(list_transform(list_transform(paragraphs, lambda x: string_split(x, ' ')),
           lambda w: list_transform(range(0, len(w), {PIECE}), lambda i: left(md5(array_to_string(w[i + 1:i + {PIECE}], ' ')), {_SHORT})))) as pieces
  from p
), s as (
  select *, list_transform(range(0, len(leaves), {SECTION}), lambda i: md5(array_to_string(leaves[i + 1:i + {SECTION}], ''))) as sections from h
), r as (
  select doc_id, kind, pieces, sha256(array_to_string(sections, '')) as root,
         sha256(array_to_string(sections, '')) || '.' || array_to_string(list_transform(sections, lambda x: left(x, {_SHORT})), '')
           || '.' || array_to_string(list_transform(leaves, lambda x: left(x, {_SHORT})), '') || '.' || array_to_string(pieces, ' ') as print
  from s
)
select e.doc_id, e.n_chars, sha256(e.edited) as edited_sha256, a.print as fingerprint, b.print as edited_fingerprint,
       case when a.root = b.root then 1.0::double else len(list_intersect(a.pieces, b.pieces))::double
         / greatest(len(list_distinct(a.pieces)), len(list_distinct(b.pieces))) end as near_edited,
       case when a.root = c.root then 1.0::double else len(list_intersect(a.pieces, c.pieces))::double
         / greatest(len(list_distinct(a.pieces)), len(list_distinct(c.pieces))) end as near_next
from e join r a on a.doc_id = e.doc_id and a.kind = 'own' join r b on b.doc_id = e.doc_id and b.kind = 'new'
join r c on c.doc_id = e.doc_id and c.kind = 'next'
"""
