import re

from helpers import clashing, documents, table
from pyspark.sql import functions as F

from feria.llm import pii

FOUND = re.compile(r"[^\s|]*@[^\s|]+|\+\d[\d() -]+\d|\b\d{16}\b|\b\d+\.\d+\.\d+\.\d+\b")


def shape(text):
    return re.sub("[0-9]", "0", re.sub("[a-zß-öø-ÿ]", "a", text))


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_driver_rows(spark):
    docs = table(spark, "documents")
    before, after = {r.doc_id: r.text for r in docs.collect()}, texts(pii.pii_report(docs, "key"))
    new = {}
    for i, text in before.items():
        a, b = FOUND.findall(text), FOUND.findall(after[i])
        assert len(a) == len(b) and FOUND.sub("", text) == FOUND.sub("", after[i])
        for x, y in zip(a, b):
            assert new.setdefault(x, y) == y  # coreference over the corpus
            if "." not in x or "@" in x:
                assert shape(x) == shape(y)
    assert new and len(set(new.values())) == len(new)  # distinct stay distinct
    assert not set(new) & set(new.values())


def test_forms(spark):
    rows = ["Mrs. Anna Smith and Mr Bob met Herr Müller, Г-жа Иванова; Mrs. Anna Smith left.",
            "A.B@X.com a.b@x.com c@X.com +1 (017) 555-7713 +1 017 555 7713 (017) 555-7713",
            "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111 078-05-1120 10.0.0.1 192.168.7.7 8.8.8.8",
            None, "", "öñ.1@mäil.example.com version 1.2.3 and 12345 and 2020-01-02", "Mrs and Mr. x"]
    docs = clashing(documents(spark, [(i, t, "s") for i, t in enumerate(rows)]))
    got = texts(pii.pii_report(docs, "key"))
    names = re.fullmatch(r"Mrs\. (\w+ \w+) and Mr (\w+) met Herr (\w+), Г-жа ([а-яА-Я]+); Mrs\. (\w+ \w+) left\.", got[0])
    assert names and names[1] == names[5] and len({names[1], names[2], names[3]}) == 3
    assert all(w.endswith("a") for w in names[1].split()) and not names[2].endswith("a") and names[4][-1] in "ая"
    mail = got[1].split()
    assert mail[0].lower() == mail[1] and mail[0][0].isupper() and mail[1].split("@")[1] == mail[2].lower().split("@")[1]
    phones = re.findall(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) \+1 (\d{3}) (\d{3}) (\d{4})", got[1])[0]
    assert phones[:3] == phones[3:] and phones[:3] != ("017", "555", "7713")
    cards = [re.sub(r"\D", "", c) for c in re.findall(r"(?:\d{4}[ -]?){4}", got[2])]
    assert len(set(cards)) == 1 and cards[0][0] == "4" and cards[0] != "4111111111111111"
    digits = [int(d) for d in cards[0]][::-1]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", got[2])
    assert ips[0].startswith("10.") and ips[1].startswith("192.168.") and not re.match(r"10\.|192\.168|127\.", ips[2])
    assert got[3] is None and got[4] == "" and got[6] == rows[6]
    assert got[5].endswith(" version 1.2.3 and 12345 and 2020-01-02") and "öñ" not in got[5]
    other = texts(pii.pii_report(docs, "another key"))
    assert other[1] != got[1] and texts(pii.pii_report(docs.repartition(3), "key")) == got


def test_collisions_are_drawn_again(spark):
    """More addresses than one-letter local parts: all get their own."""
    rows = [(i, f"{c}@z.org", "s") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    got = texts(pii.pii_report(documents(spark, rows), "key"))
    assert len(set(got.values())) == 26 and not set(got.values()) & {t for _, t, _ in rows}


def test_forms_without_room_grow(spark, monkeypatch):
    """All 1000 values of a form, 700 of another, and one alone in its own."""
    monkeypatch.setattr(pii, "LONGER", 2)
    have = [f"+{c} {i:03d}" for c, n in ((1, 1000), (2, 700)) for i in range(n)] + ["+3 123"]
    got = texts(pii.pii_report(documents(spark, [(i, t, "s") for i, t in enumerate(have)]), "key"))
    assert len(set(got.values())) == len(have) and all(re.fullmatch(r"\+\d \d{3,5}", t) for t in got.values())
    assert not set(got.values()) & set(have) and all(got[i][:3] == t[:3] for i, t in enumerate(have))
    assert sum(len(t) == 6 for t in got.values()) > 150  # what is free is used first


def test_addresses_grow(spark, monkeypatch):
    """Addresses whose draws all fail become IPv6, private ones unique local."""
    monkeypatch.setattr(pii, "LONGER", 1)
    monkeypatch.setattr(pii, "_value", lambda stream, i, below: F.lit(6))
    have = ["192.168.7.7", "192.168.1.2", "192.168.1.3", "192.168.9.9", "26.7.7.7", "8.8.8.8"]
    got = texts(pii.pii_report(documents(spark, [(i, t, "s") for i, t in enumerate(have)]), "key"))
    assert len(set(got.values())) == len(have) and not set(got.values()) & set(have)
    assert all(re.fullmatch("fd[0-9a-f]{2}(:[0-9a-f]{4}){7}", got[i]) for i in range(4))
    assert all(re.fullmatch("2001:db8(:[0-9a-f]{4}){6}", got[i]) for i in (4, 5))


def test_domains_stay_apart(spark, monkeypatch):
    """All domains of one letter but three, and two of a label each: none is
    replaced by one of them, and no two by the same."""
    monkeypatch.setattr(pii, "LONGER", 2)
    have = [f"{name}@{c}.org" for c in "abcdefghijklmnopqrstuvw" for name in ("ann", "Bob")]
    got = texts(pii.pii_report(documents(spark, [(i, t, "s") for i, t in enumerate(have)]), "key"))
    new = {}
    for i, t in enumerate(have):
        assert new.setdefault(t.split("@")[1], got[i].split("@")[1]) == got[i].split("@")[1]
    assert len(set(new.values())) == 23 and not set(new) & set(new.values())
    assert all(t.endswith(".org") for t in new.values())


def test_surnames_are_shared(spark):
    rows = ["Mr John Smith met Mr Smith, Mr Jack Smith, Mr Jones and Mrs Smith."]
    got = texts(pii.pii_report(documents(spark, [(0, rows[0], "s")]), "key"))[0]
    john, smith, jack, jones, mrs = re.fullmatch(r"Mr (\w+ \w+) met Mr (\w+), Mr (\w+ \w+), Mr (\w+) and Mrs (\w+)\.", got).groups()
    assert john.split()[1] == jack.split()[1] == smith and john != jack and len({smith, jones, mrs}) == 3
    assert not {"John", "Smith", "Jack", "Jones"} & set(re.findall(r"\w+", got))


def test_names_grow(spark, monkeypatch):
    """More names than short ones exist."""
    monkeypatch.setitem(pii.SYLLABLES, "latin", ["ba", "be"])
    monkeypatch.setattr(pii, "LONGER", 2)
    have = [f"Mr X{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    got = texts(pii.pii_report(documents(spark, [(i, t, "s") for i, t in enumerate(have)]), "key"))
    assert len(set(got.values())) == 120 and not set(got.values()) & set(have)
    assert all(re.fullmatch(r"Mr (?:B|b)(?:[ae]b)+[ae][nrls]", t) for t in got.values())


def test_long_repeated_and_empty(spark):
    row = (1, "call +1 (017) 555-7713 " * 2000, "s")
    got = pii.pii_report(documents(spark, [row, row]), "key").collect()
    assert [r.n_phone for r in got] == [2000, 2000] and "555-7713" not in got[0].text
    assert pii.pii_report(documents(spark, []), "key").count() == 0
