"""Fill-in-the-middle against a plain version, and back."""

import hashlib
import re
import time

import pytest
from llm_cases import documents, odd_rows
from pyspark.sql import functions as F

from waybill.llm import fill_in_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, seed=42, rate=50, spm=80, marks=("<P>", "<S>", "<M>")):
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    p, s, m = marks
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(x in text for x in marks) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return len(units), "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


def compared(spark, rows, **options):
    docs = documents(spark, rows)
    out = fill_in_middle.transform(docs, **options)
    marks = options.get("marks", fill_in_middle.MARKS)
    back = fill_in_middle.restored(F.col("output"), F.col("form"), marks)
    got = [(r.row.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back)
           for r in out.withColumn("back", back).collect()]
    want = [(r[0], *plain(r[0], r[1], **options), r[1] or "") for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return [x[2] for x in want]


def test_transform_is_the_plain_version(spark):
    odd = odd_rows()
    texts = ["a <P> b", "x<S>", "<M>", "<P", "<<P", "S> <", "$1 \\2 $0 {a}", "\n\nlast ", " ",
             "one\x0btwo\x85three\u2028four\u00a0five", "\U0001F600 \U0001F600\U0001F601 z", "a\r\nb",
             "<", "<S", "P> <S P>"]
    rows = odd + [(100 + 40 * j + i, t, "en", "a") for j, t in enumerate(texts) for i in range(40)]
    forms = compared(spark, rows)
    assert {"plain", "psm", "spm"} == set(forms)
    assert compared(spark, rows, rate=100, spm=50, seed=7).count("plain") < 200
    compared(spark, odd, rate=100, marks=("$p\\", "{s}", "[^m]"))


def test_marks_must_not_overlap():
    for marks in (("<P>", "<P>", "<M>"), ("aba", "x", "y"), ("ab", "bc", "y"), ("", "x", "y"),
                  ("abc", "b", "y")):
        with pytest.raises(ValueError, match="overlap"):
            fill_in_middle.checked(marks)


def test_no_python_no_shuffle_and_empty_tables(spark):
    docs = documents(spark, odd_rows())
    out = fill_in_middle.digest(fill_in_middle.transform(docs))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan
    assert fill_in_middle.transform(docs.limit(0)).collect() == []


def test_very_long_text(spark):
    rows = spark.createDataFrame([(i,) for i in range(8)], "doc_id long").select(
        "doc_id", F.repeat(F.lit("word \tzwölf\n"), 800_000).alias("text"))
    start = time.time()
    (r,) = fill_in_middle.digest(fill_in_middle.transform(rows, rate=100)).where(
        "restored_sha256 = sha2(repeat('word \tzwölf\n', 800000), 256)").agg(
        F.count("*").alias("k"), F.min("n").alias("n"), F.max("middle_chars").alias("m")).collect()
    assert (r.k, r.n) == (8, 1_600_001) and r.m > 1000
    assert time.time() - start < 120
