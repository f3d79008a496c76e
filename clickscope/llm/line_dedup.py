"""Line dedup by a log-template tree, in DataFrame functions only.

A line's tokens with a digit or an ``@`` are masked (``<*>``), as log parsers do first;
what is left is its *form*.  The tree has a fixed depth: the token count, then the
three leading tokens, lead to a leaf.  In a leaf with several forms the fields are
generalised: a token that fewer than ``family`` documents have at its position in the
leaf cannot be a constant of a template that so many share, so it becomes ``<*>``; the
form with its variable fields is its template.  A template must keep half of its
tokens.

Lines whose form is in ``min_docs`` documents or more, or whose template (where it has
variable fields of its own) is in ``family`` documents or more, recur; they
are dropped from all documents but the first (the smallest doc_id), so that one copy of
a text that has many copies stays.  Lines of fewer than ``min_tokens`` tokens are
never dropped (blank lines have none).

Only leaves that enough documents reach are taken apart, and of them each form once,
whatever the number of its lines.  Forms, positions and templates travel as hashes; each
document sends a form once, and counts are combined before the shuffle, so a line or
a leaf that a third of all documents hold arrives as counts.  What is dropped is
joined back by form, which the join splits where it is hot.

Cases: a null text stays null, an empty one empty; a document may lose all its
lines (its text is then empty, the row stays); null ids count as documents and
come after all others; repeated rows (same id and text) count as one document and are
decided alike; an empty table gives an empty table; all other columns, whatever their names, are
kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, packed, written

MIN_DOCS = 2
FAMILY = 5
MIN_TOKENS = 1
#: Leading tokens on the way to a leaf.
LEADING = 3
LAST = 9223372036854775807
#: Bits of the marks of a set of hashes, in blocks of Spark's bitmap functions: 4 MB in all.
MARKS, BLOCK = 1 << 25, 1 << 15


def _norm(line: Column) -> Column:
    """Tokens joined by one space; the regular expression runs only where it is needed."""
    odd = line.contains("  ") | line.rlike("[\\x09-\\x0D]")
    return F.trim(F.when(odd, F.regexp_replace(line, "[\\x20\\x09-\\x0D]+", " ")).otherwise(line))


def _count(norm: Column) -> Column:
    return F.when(norm == "", 0).otherwise(F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1)


def line_forms(docs: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, id, row, line_no, tokens, form, h1, h2, leaf) of the lines of every text; ``row`` is a
    hash of id and text, ``h1`` and ``h2`` stand for the form, ``leaf`` for its place in the tree."""
    lines = docs.where("text is not null").select(
        "doc_id", F.xxhash64("doc_id", "text").alias("row"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    norm = lines.select("doc_id", "row", "line_no", _norm(F.col("line")).alias("norm"))
    form = F.when(F.col("norm").rlike("[0-9@]"), F.regexp_replace("norm", "[^ ]*[0-9@][^ ]*", "<*>")).otherwise(F.col("norm"))
    forms = norm.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("id"), "row", "line_no", _count(F.col("norm")).alias("tokens"),
                        form.alias("form")).where(F.col("tokens") >= max(1, int(min_tokens)))
    return forms.select("*", F.xxhash64("form").alias("h1"), F.xxhash64(F.lit(7), "form").alias("h2"),
                        F.xxhash64("tokens", F.substring_index("form", " ", LEADING)).alias("leaf"))


def _in_marked(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` (a hash) is in ``found``, and a few that share a mark with one of it: a bitmap of
    ``MARKS`` bits goes to every task, so rows that cannot match stay where they are."""
    block, bit = F.expr(f"pmod({key}, {MARKS}) div {BLOCK}"), F.expr(f"pmod({key}, {BLOCK})")
    bitmaps = found.select(block.alias("block"), bit.alias("bit")).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = "cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)"
    return (rows.select("*", block.alias("block"), bit.alias("bit")).join(F.broadcast(bitmaps), "block")
            .where(F.expr(f"shiftright({byte}, cast(bit % 8 as int)) % 2 = 1")).select(*rows.columns))


def templates(lines: DataFrame, forms: DataFrame, leaves: DataFrame, family: int = FAMILY) -> DataFrame:
    """(h1, h2, t1, t2) of the forms whose template has variable fields of its own; equal templates
    have equal t1 and t2.  Leaves beside ``leaves`` that a mark lets through have no such template."""
    # each form once, with its tokens
    text = _in_marked(lines, leaves, "leaf").groupBy("h1", "h2").agg(F.first("form").alias("form"))
    fields = written(_in_marked(forms, leaves, "leaf").join(text, ["h1", "h2"])
                     .select("h1", "h2", "leaf", "docs", "tokens", F.posexplode(F.split("form", " ")).alias("pos", "token")), "line-fields")
    constant = (fields.groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("docs"))
                .where(F.col("docs") >= int(family)).select("leaf", "pos", "token", F.lit(True).alias("same")))
    seen = fields.join(constant, ["leaf", "pos", "token"], "left")
    masked = F.col("token").contains("<*>")
    token = F.when(F.col("same"), F.col("token")).otherwise("<*>")
    out = (seen.groupBy("h1", "h2", "leaf", "tokens").agg(
        F.bit_xor(F.xxhash64("pos", token)).alias("x"), F.bit_xor(F.xxhash64(token, F.lit(3), "pos")).alias("y"),
        F.count_if(F.col("same").isNull()).alias("own"), F.count_if(masked | F.col("same").isNull()).alias("wild"))
        .where("own > 0 and 2 * wild <= tokens")
        .select("h1", "h2", F.xxhash64("leaf", "x").alias("t1"), F.xxhash64("y", "leaf").alias("t2")))
    out = written(out, "line-templates")
    drop_tables(fields)
    return out


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, family: int = FAMILY, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, row, gone): the numbers of the lines that each document loses."""
    lines = written(line_forms(docs, min_tokens), "line-lines", "zstd")
    once = written(lines.groupBy("h1", "h2", "leaf", "id", "row").agg(F.max("tokens").alias("tokens")), "line-once")
    forms = written(once.groupBy("h1", "h2", "leaf").agg(F.count("*").alias("docs"), F.min("id").alias("first"), F.max("tokens").alias("tokens")),
                    "line-forms")
    leaves = written(forms.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count("*").alias("forms"))
                     .where(f"docs >= {int(family)} and forms > 1").select("leaf"), "line-leaves")
    of = templates(lines, forms, leaves, family)
    # the first document of what recurs: of a form by itself, and of its template
    alone = forms.where(F.col("docs") >= int(min_docs)).select("h1", "h2", "first")
    groups = (_in_marked(once, leaves, "leaf").join(of, ["h1", "h2"]).select("t1", "t2", "id", "row").distinct()
              .groupBy("t1", "t2").agg(F.count("*").alias("docs"), F.min("id").alias("first"))
              .where(F.col("docs") >= int(family)).select("t1", "t2", "first"))
    often = written(alone.unionByName(of.join(groups, ["t1", "t2"]).select("h1", "h2", "first"))
                    .groupBy("h1", "h2").agg(F.min("first").alias("first")), "line-recurring")
    gone = (_in_marked(lines.select("doc_id", "id", "row", "line_no", "h1", "h2"), often, "h1")
            .join(often, ["h1", "h2"]).where("id > first"))
    out = written(gone.groupBy("doc_id", "row").agg(F.collect_set("line_no").alias("gone")), "line-gone")
    drop_tables(lines, once, forms, leaves, of, often)
    return out


def _marked(docs: DataFrame, **params) -> DataFrame:
    """(doc, gone): every row as one column, and the lines that it loses (null: none)."""
    gone = dropped_lines(docs, **params).select(F.col("doc_id").alias("of"), "row", "gone")
    keyed = docs.select(packed(docs), F.col("doc_id").alias("id"),
                        F.xxhash64("doc_id", "text").alias("key"))
    return keyed.join(gone, (F.col("key") == F.col("row")) & F.col("id").eqNullSafe(F.col("of")), "left").select("doc", "gone")


def _left(text: Column, gone: Column) -> Column:
    """The lines of ``text`` whose numbers are not in ``gone``: the numbers are taken apart as sets,
    so a text of very many lines costs its length."""
    def cut(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    return F.when(gone.isNull(), text).otherwise(F.transform(F.array(F.split(text, "\n")), cut)[0])


def without_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, family: int = FAMILY, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``docs`` with the recurring lines cut out of ``text``."""
    rows = _marked(docs, min_docs=min_docs, family=family, min_tokens=min_tokens)
    left = _left(F.col("doc")["text"], F.col("gone"))
    return rows.select(*[(left if c == "text" else F.col("doc")[c]).alias(c) for c in docs.columns])


def summary(docs: DataFrame, min_docs: int = MIN_DOCS, family: int = FAMILY, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the text that is left; null for a null text)."""
    rows = _marked(docs.select("doc_id", "text"), min_docs=min_docs, family=family, min_tokens=min_tokens)
    text, gone = F.col("doc")["text"], F.col("gone")
    return rows.select(
        F.col("doc")["doc_id"].alias("doc_id"),
        F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))).cast("long").alias("n_lines"),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"),
        F.sha2(_left(text, gone).cast("binary"), 256).alias("kept_sha256"))


def template_sql(table: str) -> str:
    """DuckDB: (r, id, own, line_no, line, tokens, form, leaf) of the lines of a table with text."""
    return f"""
  select *, {{'n': tokens, 'h': string_split(form, ' ')[1:{LEADING}]}} as leaf from (
   select *, case when norm = '' then 0 else length(norm) - length(replace(norm, ' ', '')) + 1 end as tokens,
           regexp_replace(norm, '[^ ]*[0-9@][^ ]*', '<*>', 'g') as form
         from (select *, trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') as norm
               from (select r, id, own, unnest(string_split(text, chr(10))) as line,
                       generate_subscripts(string_split(text, chr(10)), 1) as line_no from {table})))"""


ORACLE = f"""
with d as (select row_number() over () as r, doc_id, coalesce(doc_id, {LAST}) as id, md5(text) as own, text from documents),
t as ({template_sql('d')}),
o as (select distinct form, leaf, tokens, id, own from t where tokens >= {MIN_TOKENS}),
f as (select form, leaf, tokens, count(*) as docs, min(id) as first from o group by all),
apart as (select * from f semi join (select leaf from f group by leaf having sum(docs) >= {FAMILY} and count(*) > 1) using (leaf)),
fields as (select form, leaf, tokens, docs, unnest(string_split(form, ' ')) as token,
             generate_subscripts(string_split(form, ' '), 1) as pos from apart),
c as (select leaf, pos, token from fields group by all having sum(docs) >= {FAMILY}),
m as (select form, leaf, tokens, list(case when c.token is null then '<*>' else x.token end order by pos) as template,
        count(*) filter (c.token is null) as own, count(*) filter (c.token is null or contains(x.token, '<*>')) as wild
      from fields x left join c using (leaf, pos, token) group by all),
v as (select form, leaf, template from m where own > 0 and 2 * wild <= tokens),
g as (select leaf, template, min(id) as first from (select distinct leaf, template, id, own from o join v using (form, leaf))
      group by all having count(*) >= {FAMILY}),
often as (select form, min(first) as first from (
  select form, first from f where docs >= {MIN_DOCS} union all select form, first from v join g using (leaf, template)) group by form),
k as (select t.r, t.line_no, t.line, b.first is not null and t.tokens >= {MIN_TOKENS} and t.id > b.first as gone
      from t left join often b using (form)),
s as (select r, count(*) as n_lines, count(*) filter (gone) as n_dropped,
        coalesce(string_agg(line, chr(10) order by line_no) filter (not gone), '') as kept from k group by r)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped, sha256(kept) as kept_sha256
from d left join s using (r)
"""
