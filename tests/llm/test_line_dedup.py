import re

import pytest
from helpers import clashing, documents, table

from feria.llm import common, line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, last + (x != y))
    return row[-1]


def plain(raw):
    """A line as it is compared: without blanks at the ends, A-Z lower-cased."""
    return re.sub("[A-Z]", lambda m: m[0].lower(), raw.strip(" \t\n\x0b\x0c\r"))


def brute(rows, edits, least):
    """(doc_id, lines, exact, near, places) of each document, all pairs compared."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, out = [], []
    for k in order:
        i, text = rows[k]
        full, exact, near, places = 0, 0, 0, []
        for n, raw in enumerate((text or "").split("\n")):
            if not (line := plain(raw)):
                continue
            full += 1
            if line in seen:
                exact += 1
            elif len(line) >= least and any(len(x) >= least and abs(len(x) - len(line)) <= edits and distance(x, line) <= edits for x in seen):
                near += 1
                seen.append(line)
            else:
                seen.append(line)
                continue
            places.append(n)
        out.append((i, full, exact, near, places))
    # a line near an earlier one goes everywhere, as do all its repeats: counted above
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_exact, r.n_near, list(r.removed)) for r in df.collect()), key=str)


def test_driver_rows(spark):
    docs = table(spark, "documents")
    rows = [(r.doc_id, r.text) for r in docs.limit(60).collect()]
    few = documents(spark, [(i, t, "s") for i, t in rows])
    assert got(line_dedup.line_report(few)) == brute(rows, 1, line_dedup.LEAST_LENGTH)


@pytest.mark.parametrize("edits", [1, 2])
def test_edits_at_every_place(spark, edits):
    """One edit, or two, at every place of a line are found; three are not."""
    base = "abcdefghij klmnopqrst uvwxyz"
    rows = [(0, base)]
    for i in range(len(base)):
        rows += [(len(rows), base[:i] + base[i + 1:]), (len(rows) + 1, base[:i] + "é" + base[i:]), (len(rows) + 2, base[:i] + "#" + base[i + 1:])]
        j = (i * 7 + 3) % len(base)
        two = base[:i] + "1" + base[i + 1:]
        rows.append((len(rows), two[:j] + two[j + 1:]))
    rows.append((len(rows), "123" + base[3:]))
    got_rows = got(line_dedup.line_report(documents(spark, [(i, t, "s") for i, t in rows]), edits))
    assert got_rows == brute(rows, edits, line_dedup.LEAST_LENGTH)


def test_edges(spark):
    long = "a line that is long enough to be compared"
    rows = [(1, None), (2, ""), (3, " \n\n  "), (4, long + "\nshort\n" + long), (5, " " + long + " \nshorn\nshort"), (None, long + "!"),
            (6, long[:-1] + "X\n" + "y" * 2_000), (7, "x" * 2_000)]
    docs = clashing(documents(spark, [(i, t, "s") for i, t in rows]))
    assert got(line_dedup.line_report(docs)) == brute(rows, 1, line_dedup.LEAST_LENGTH)
    kept = line_dedup.deduped(docs)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[1] is None and texts[2] == "" and texts[3] == " \n\n  "
    assert texts[4] == long + "\nshort" and texts[5] == "shorn" and texts[None] == "" and texts[6] == "y" * 2_000
    none = documents(spark, [])
    assert line_dedup.line_report(none).count() == 0 and line_dedup.deduped(none).count() == 0


def test_repeated_rows_are_one_document(spark):
    row = (1, "a line that is long enough to be compared\nother", "s")
    docs = documents(spark, [row, row, (2, row[1], "s")])
    assert got(line_dedup.line_report(docs)) == [(1, 2, 0, 0, [])] * 2 + [(2, 2, 2, 0, [0, 1])]


def test_lines_are_compared_trimmed_and_lower_cased(spark):
    long = "A line that is long enough to be compared"
    rows = [(1, long + "\r\n\r\nshort\r\n\r\n\t\nend"), (2, "\t" + long.upper() + " \t\r\n\r\nSHORT\n \x0b\x0c\nEnd\r"),
            (3, "É short\n\r\né short")]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    assert got(line_dedup.line_report(docs)) == [(1, 3, 0, 0, []), (2, 3, 3, 0, [0, 2, 4]), (3, 2, 0, 0, [])]
    texts = {r.doc_id: r.text for r in line_dedup.deduped(docs).collect()}
    assert texts == {1: rows[0][1], 2: "\r\n \x0b\x0c", 3: rows[2][1]}


def test_few_rows_with_many_places_are_not_broadcast(spark, monkeypatch):
    """The bound is on the removed lines, not on the documents that lose some."""
    monkeypatch.setattr(common, "BROADCAST_NUMBERS", 30, raising=False)
    docs = documents(spark, [(i, "\n".join(["same"] * (20 if i else 1)), "s") for i in range(3)])
    out = line_dedup.deduped(docs)
    assert "broadcast" not in out._jdf.queryExecution().logical().toString()
    assert {r.doc_id: r.text for r in out.collect()} == {0: "same", 1: "", 2: ""}
    few = line_dedup.deduped(docs.where("doc_id < 2"))
    assert "broadcast" in few._jdf.queryExecution().logical().toString()


def test_the_line_stage_is_compiled(spark, monkeypatch):
    """The JVM compiles no method over 8000 bytes: each line would be interpreted."""
    longest, saved = [], line_dedup.saved

    def noted(df, tag):
        if tag == "lines-each":
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
            longest.append(max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode)))))
        return saved(df, tag)

    monkeypatch.setattr(line_dedup, "saved", noted)
    docs = documents(spark, [(1, "a line that is long enough to be compared", "s"), (2, "a line that is long enough to be compareD!", "s")])
    assert got(line_dedup.line_report(docs)) == [(1, 1, 0, 0, []), (2, 1, 0, 1, [0])]
    assert longest and longest[0] < 8000
