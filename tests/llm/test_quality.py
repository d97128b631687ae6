import random
import re
from collections import Counter

from helpers import clashing, documents, table, words

from feria.llm import quality


def brute(text):
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i: i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(inside), failed


def verdicts(rows):
    """kept of each row of (source, text), by counting distinct texts per host and line."""
    def plain(line):
        return " ".join(words(re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), line))))

    texts = {(s, t or "") for s, t in rows}
    docs, seen = Counter(s for s, _ in texts), Counter()
    lines = {(s, t): [plain(x) for x in t.split("\n") if words(x)] for s, t in texts}
    for (s, t), held in lines.items():
        seen.update((s, x) for x in set(held))
    often = {k for k, n in seen.items() if n > 20 and n > 0.1 * docs[k[0]]}
    out = []
    for s, t in rows:
        n = len(words(t))
        lost = sum(len(words(x)) for x in lines[s, t or ""] if (s, x) in often)
        out.append(not brute(t)[-1] and not (lost and n - lost < 0.3 * n))
    return out


def judged(spark, rows):
    """Rows (doc_id, text, source) hold against the brute force; their verdicts."""
    got = {r.doc_id: r.kept for r in quality.judge(documents(spark, rows)).collect()}
    want = dict(zip((i for i, _, _ in rows), verdicts([(s, t) for _, t, s in rows])))
    assert got == want
    assert sorted(r.doc_id for r in quality.kept_documents(documents(spark, rows)).collect()) == sorted(i for i, k in want.items() if k)
    return want


def test_driver_rows(spark):
    docs = table(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = quality.judge(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:7] == brute(texts[r.doc_id])
    rows = [(r.source, r.text) for r in docs.orderBy("doc_id").collect()]
    assert [r.kept for r in sorted(got, key=lambda r: r.doc_id)] == verdicts(rows)


def spelled(n):
    """A number in letters (digits are all alike in a normalised line)."""
    return "".join(chr(97 + int(d)) for d in str(n))


def page(i, words=80):
    """Prose of its own for each i."""
    return "\n".join(" ".join(f"w{spelled(i)}x{spelled(a)}y{spelled(b)}" for b in range(10)) for a in range(words // 10))


def test_frequent_lines_deplete(spark):
    banner = "\n".join(" ".join(f"menu{spelled(a)}item{spelled(b)}" for b in range(30)) for a in range(4))
    rows = [(i, banner + "\n" + page(i, 10), "h") for i in range(60)]         # little beside the banner
    rows += [(100 + i, banner + "\n" + page(100 + i, 200), "h") for i in range(60)]   # much beside it
    rows += [(200, banner + "\n" + page(200, 10), "other"), (201, banner + "\n" + page(201, 10), None)]
    got = {r.doc_id: r for r in quality.judge(documents(spark, rows)).collect()}
    assert not any(got[i].kept for i in range(60)) and not any(got[i].base_failed for i in range(60))
    assert all(got[100 + i].kept for i in range(60))
    assert got[200].kept and got[201].kept  # hosts are counted apart


def test_exact_copies_count_once(spark):
    """A page 200 times is one document; pages that differ in a line are many."""
    rows = [(i, page(0), "h") for i in range(200)]
    assert all(judged(spark, rows).values())
    rows += [(1000 + i, page(1) + f"\nlast line of copy {spelled(i)}", "h") for i in range(200)]
    got = judged(spark, rows)
    assert all(got[i] for i in range(200)) and not any(got[1000 + i] for i in range(200))


def test_pages_of_boilerplate_only(spark):
    """Each page holds 10 of 30 banner lines, and nothing else."""
    banner = [" ".join(f"menu{spelled(a)}item{spelled(b)}" for b in range(10)) for a in range(30)]
    draw = random.Random(1)
    rows = [(i, "\n".join(draw.sample(banner, 10)), "h") for i in range(200)]
    rows += [(1000 + i, page(i), "h") for i in range(60)]
    got = judged(spark, rows)
    assert not any(got[i] for i in range(200)) and all(got[1000 + i] for i in range(60))


def test_own_lines_that_begin_alike(spark):
    banner = "\n".join(" ".join(f"menu{spelled(a)}item{spelled(b)}" for b in range(10)) for a in range(20))
    own = [" ".join(f"w{spelled(i * 8 + b)}" for b in range(8)) for i in range(300)]
    rows = [(i, f"{banner}\nProduct details for {own[i]}", "h") for i in range(300)]
    assert not any(judged(spark, rows).values())


def test_templates_with_one_own_line(spark):
    """Lines of a template are frequent however many of them a page holds."""
    rows, sizes = [], (10, 20, 40)
    for b in sizes:
        banner = "\n".join(" ".join(f"b{spelled(b)}menu{spelled(a)}item{spelled(c)}" for c in range(10)) for a in range(b))
        rows += [(1000 * b + i, banner + "\n" + page(1000 * b + i, 10), f"h{b}") for i in range(300)]
    got = quality.judge(documents(spark, rows)).collect()
    assert len(got) == 900 and not any(r.base_failed for r in got)
    assert not any(r.kept for r in got)
    assert quality.kept_documents(documents(spark, rows)).count() == 0


def test_edges(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "\n \n", None), (4, "é # é\né # é", "s"), (None, page(5), "s"), (6, page(6), None),
            (6, page(6), None), (7, "x " * 60, "s"), (8, page(8, 100_000), "s")]
    docs = clashing(documents(spark, rows))
    got = quality.judge(docs).collect()
    assert sorted(tuple(r)[1:7] for r in got) == sorted(brute(t) for _, t, _ in rows)
    assert sorted((r.doc_id for r in got if r.kept), key=str) == [6, 6, 8, None]
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [6, 6, 8, None]
    none = documents(spark, [])
    assert quality.judge(none).count() == 0 and quality.kept_documents(none).count() == 0
