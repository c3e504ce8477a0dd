"""Fill-in-the-middle transformation by one counted regular expression a document.

A text is a sequence of units: white space together with the word behind it, or white space at the
end. ``regexp_count`` of the unit gives their number n. Two keyed draws from 0 to n place the two
cuts; the row's own pattern

    \\A((?:unit){a}+)((?:unit){b-a}+)(.*+)\\z

matches the whole text once, its three groups are prefix, middle and suffix, and the replacement
writes them in their new order. Both counted groups are possessive: a repetition of a group that
may not give back is a loop in the regular expression engine, neither recursion nor backtracking,
so a text of millions of words needs no stack and time in proportion to its length.

Draws: h1 to h4 are the first four 8-digit groups of the hex sha256 of ``seed:doc_id``. The cuts are
h1 and h2 modulo n + 1. h3 modulo 100 decides whether the document is rearranged at all (``rate``
of 100), h4 modulo 100 whether the suffix comes first (spm, ``spm`` of 100) or the prefix (psm).
Reruns agree, and a document's form does not depend on others. Nothing is shuffled; all work is in
Spark's own functions.

The marks must not overlap each other; texts that contain one stay plain, so each mark stands in an
output once, and ``restored`` finds the text again from output and form.

Defined cases: null and empty texts have no units and stay plain, with empty output. A null doc_id
draws as the empty id. Rows with one doc_id draw alike, each over its own text. Other columns pass
through in ``row``, whatever their names. A whole text is one row: ``regexp_count`` holds the units
of one text in memory (an estimated 60 bytes each).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
MARKS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = 42, 50, 80
PLAIN = "plain"


def checked(marks: tuple[str, str, str]) -> tuple[str, str, str]:
    """Marks that cannot overlap: none holds another, no end of one is the begin of one."""
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            if not a or (i != j and a in b) or any(
                    a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (i != j))):
                raise ValueError(f"marks {a!r} and {b!r} overlap")
    return marks


def _draw(doc_id: Column, seed: int, i: int) -> Column:
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(key, 256), 8 * i - 7, 8), 16, 10).cast("long")


def _quoted(mark: str) -> str:
    """A mark as it stands in a replacement."""
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM,
              marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output)."""
    p, s, m = map(_quoted, checked(marks))
    h = [_draw(F.col("doc_id"), seed, i) for i in (1, 2, 3, 4)]
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    text, n = F.col("text"), F.col("n")
    marked = F.lit(False)
    for mark in marks:
        marked |= F.contains(text, F.lit(mark))
    counted = docs.select(
        row, F.coalesce("text", F.lit("")).alias("text"), (h[2] % 100).alias("h3"),
        (h[3] % 100).alias("h4"), h[0].alias("h1"), h[1].alias("h2")).select(
        "*", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"))
    form = (F.when((text == "") | marked | (F.col("h3") >= rate), PLAIN)
            .when(F.col("h4") < spm, "spm").otherwise("psm"))
    x, y = F.col("h1") % (n + 1), F.col("h2") % (n + 1)
    cut = counted.select("row", "text", "n", form.alias("form"), F.least(x, y).alias("a"),
                         F.abs(x - y).alias("b"))
    pattern = F.concat(F.lit(rf"\A((?:{UNIT}){{"), F.col("a").cast("string"),
                       F.lit(rf"}}+)((?:{UNIT}){{"), F.col("b").cast("string"),
                       F.lit(r"}+)((?s:.*+))\z"))
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    made = cut.select("row", "n", "form", F.when(F.col("form") == PLAIN, text).otherwise(
        F.regexp_replace(text, pattern, order)).alias("output"))
    prefix, middle, _ = parts(F.col("output"), F.col("form"), marks)
    return made.select("row", "n", "form", F.char_length(prefix).cast("long").alias("prefix_chars"),
                       F.char_length(middle).cast("long").alias("middle_chars"), "output")


def parts(output: Column, form: Column,
          marks: tuple[str, str, str] = MARKS) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output; null where it is plain."""
    p, s, m = marks
    first = lambda x, mark: F.substring_index(x, mark, 1)
    last = lambda x, mark: F.substring_index(x, mark, -1)
    head = first(output, m)
    spm, psm = form == "spm", form == "psm"
    return (F.when(spm, last(head, p)).when(psm, last(first(head, s), p)),
            F.when(spm | psm, last(output, m)),
            F.when(spm, last(first(head, p), s)).when(psm, last(head, s)))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that was transformed."""
    return F.when(form == PLAIN, output).otherwise(F.concat(*parts(output, form, marks)))


def digest(made: DataFrame) -> DataFrame:
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = r"""
with d as (select doc_id, coalesce(text, '') as text,
                  sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents),
u as (select *, regexp_extract_all(
        text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as unit,
        ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
        ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
      from d),
f as (select *, len(unit) as n, least(h1 % (len(unit) + 1), h2 % (len(unit) + 1)) as a,
             greatest(h1 % (len(unit) + 1), h2 % (len(unit) + 1)) as b,
             case when text = '' or contains(text, '<P>') or contains(text, '<S>')
                       or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
                  when h4 % 100 < 80 then 'spm' else 'psm' end as form from u),
c as (select doc_id, text, n, form, array_to_string(unit[1:a], '') as p,
             array_to_string(unit[a + 1:b], '') as m, array_to_string(unit[b + 1:], '') as s
      from f)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then text when 'spm'
              then '<S>' || s || '<P>' || p || '<M>' || m
              else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from c
"""
