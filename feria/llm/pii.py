"""Personal data replaced by surrogates, in DataFrame functions only.

Every distinct entity gets one replacement in the whole corpus, drawn from a
keyed digest of its canonical form, so that equal entities stay equal, whatever
their spelling, and nothing can be traced back without the key. A replacement
has its entity's type and form:

* email: letter for letter and digit for digit, punctuation, case and the last
  label kept; addresses of one domain share the replaced domain;
* card: the first digit kept, valid by its check digit if the entity was;
* phone: the country code kept; ssn, card and phone keep their punctuation;
* ip: private addresses stay in their network, others get a public one;
* name after a title: the title, number of names, script and gender kept; "Mr
  Smith" and "Mr John Smith" share the replaced surname.

Domains and surnames are drawn first, then what stands before them. Replacements
are checked: none may equal an entity of its type in the corpus or the replacement
of another one; those that do are drawn again. After some draws they grow: names
by syllables, emails and domains by letters, phones, cards and ssn by digits, and
addresses become IPv6 (unique local ones if private). So no form runs out, and no
value of the corpus stays in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feria.llm.common import packed, saved

#: The most draws, and that from which on replacements grow, by one at each multiple.
DRAWS, LONGER = 64, 8
#: Entities of one domain or surname are joined with it in so many parts.
PARTS = 8

TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Г-жа"), "m": ("Mr", "Mister", "Herr", "Señor", "Monsieur", "Г-н")}
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d+-])(?:\d{4}[ -]?){3}\d{4}(?!\d)",
    "phone": r"(?<!\d)(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\d-])",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?",
}
ANY = "|".join(PATTERNS.values())
#: Syllables and endings of replaced names, by script and gender.
SYLLABLES = {"latin": "ba be bo da de do fa ka ke la le lo ma me mi na ne ni ra re ri sa se ta te ti va ve vi za".split(),
             "cyrillic": "ба бе да до ка ко ла ле ма ме ми на не ни ра ре ри са се та те ти ва ве ви за".split()}
ENDINGS = {"latin": {"f": "la na ra ia".split(), "m": "n r l s".split()}, "cyrillic": {"f": "ла на ра ия".split(), "m": "н р л с".split()}}
ACCENTED, CYRILLIC = "áàâäãåæçéèêëíìîïñóòôöõøúùûüýß", "абвгдежзиклмнопрстуфхцчшщэюя"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def kind_of(entity: Column) -> Column:
    script = F.when(entity.rlike(r" \p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    gender = F.when(entity.rlike(rf"^(?:{'|'.join(TITLES['f'])})\b"), F.lit("f")).otherwise(F.lit("m"))
    return (F.when(entity.contains("@"), F.lit("email")).when(entity.rlike(r"^\d+\.\d+\.\d+\.\d+$"), F.lit("ip"))
            .when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.lit("ssn")).when(entity.rlike(r"^(?:\d{4}[ -]?){3}\d{4}$"), F.lit("card"))
            .when(entity.rlike(r"^\p{L}"), F.concat_ws("_", F.lit("name"), gender, script)).otherwise(F.lit("phone")))


def canon_of(entity: Column, kind: Column) -> Column:
    """What is the same for all spellings of an entity; a phone's country code
    is set off by ``+``."""
    digits = F.regexp_replace(entity, r"\D", "")
    code = F.when(entity.startswith("+"), F.regexp_extract(entity, r"^\+(\d{1,3}?)(?=\D)", 1)).otherwise(F.lit(""))
    return (F.when(kind == "email", F.translate(entity, UPPER, LOWER)).when(kind == "ip", entity)
            .when(kind.isin("ssn", "card"), digits)
            .when(kind == "phone", F.concat(code, F.lit("+"), F.substr(digits, F.length(code) + 1)))
            .otherwise(F.lower(F.regexp_extract(entity, r"^\S+ (.*)$", 1))))


def _stream(key: str, kind: Column, of: Column, draw: Column, size: Column) -> Column:
    """Four hex digits for each of ``size`` characters, from the keyed digest."""
    blocks = F.sequence(F.lit(0), F.floor(size / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", F.lit(key), kind, of, draw, b), 512)), "")


def _value(stream: Column, i: Column, below: int) -> Column:
    return F.pmod(F.conv(F.substr(stream, 4 * i + 1, F.lit(4)), 16, 10).cast("int"), F.lit(below))


def _mapped(text: Column, stream: Column) -> Column:
    """``text`` with every letter and digit replaced by one of its sort."""
    def drawn(letters: str, i: Column) -> Column:
        return F.substr(F.lit(letters), _value(stream, i, len(letters)) + 1, F.lit(1))

    def one(i: Column) -> Column:
        c = F.substr(text, i + 1, F.lit(1))
        return (F.when(c.rlike("[0-9]"), drawn("0123456789", i)).when(c.rlike("[a-z]"), drawn(LOWER, i))
                .when(c.rlike(r"\p{IsCyrillic}"), drawn(CYRILLIC, i)).when(c.rlike(r"[\p{L}&&\p{IsLatin}]"), drawn(ACCENTED, i))
                .when(c.rlike(r"[\p{L}\p{N}]"), drawn(LOWER, i)).otherwise(c))
    indices = F.filter(F.sequence(F.lit(0), F.length(text)), lambda i: i < F.length(text))
    return F.array_join(F.transform(indices, one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check over all digits, modulo 10."""
    def term(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    terms = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), term)
    return F.aggregate(terms, F.lit(0), lambda a, b: a + b) % 10


def _drawn(key: str) -> Column:
    """The replacement of (kind, canon) at this draw, in canonical form: what is
    before its domain or surname is ``head``, and the new one ``tail``."""
    kind, canon, head, tail, draw = (F.col(c) for c in ("kind", "canon", "head", "tail", "draw"))
    longer = F.floor(draw / LONGER).cast("int")
    whole = _stream(key, kind, canon, draw, F.length(canon) + 8 + longer)
    more = F.substr(F.translate(whole, "0123456789", "ghijklmnop"), F.lit(1), longer)
    email = F.concat(_mapped(head, whole), more, F.lit("@"), tail)
    last = F.substring_index(canon, ".", -1)
    domain = F.concat(more, _mapped(F.substr(canon, F.lit(1), F.length(canon) - F.length(last)), whole), last)
    grown = F.concat(canon, F.repeat(F.lit("0"), longer))
    digits = _mapped(grown, whole)
    card = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(digits, F.lit(2)))
    body = F.substr(card, F.lit(1), F.length(card) - 1)
    valid = F.concat(body, F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))
    card = F.when(_luhn(F.when(kind == "card", canon).otherwise(F.lit("0"))) == 0, valid).otherwise(card)
    phone = F.concat(F.substring_index(canon, "+", 1), F.lit("+"), _mapped(F.substring_index(grown, "+", -1), whole))
    octets = [(_value(whole, F.lit(i), 254) + 1).cast("string") for i in range(4)]
    groups = [F.lower(F.substr(whole, F.lit(4 * i + 1), F.lit(4))) for i in range(8)]
    public = (_value(whole, F.lit(4), 80) + 20).cast("string")
    wide, near = canon.rlike(r"^(?:10|127)\."), canon.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2\d|3[01])|169\.254)\.")
    ip = (F.when((longer > 1) & (wide | near), F.concat_ws(":", F.concat(F.lit("fd"), F.substr(groups[0], F.lit(1), F.lit(2))), *groups[1:]))
          .when(longer > 1, F.concat_ws(":", F.lit("2001:db8"), *groups[2:]))
          .when(wide, F.concat_ws(".", F.substring_index(canon, ".", 1), *octets[1:]))
          .when(near, F.concat_ws(".", F.substring_index(canon, ".", 2), *octets[2:]))
          .otherwise(F.concat_ws(".", public, *octets[1:])))

    def name(script: str, gender: str) -> Column:
        syllables, endings = (F.array(*map(F.lit, x)) for x in (SYLLABLES[script], ENDINGS[script][gender]))

        def word(i: Column) -> Column:
            at = [_value(whole, 4 * i + k, len(SYLLABLES[script])) for k in range(3)]
            grown = _stream(key, F.lit("more"), canon, draw, 64 * (i + 1))
            extra = F.filter(F.sequence(F.lit(0), longer), lambda k: k > 0)
            extra = F.transform(extra, lambda k: F.get(syllables, _value(grown, 64 * i + k, len(SYLLABLES[script]))))
            return F.concat(*[F.get(syllables, a) for a in at], F.array_join(extra, ""),
                            F.get(endings, _value(whole, 4 * i + 3, len(ENDINGS[script][gender]))))
        words = F.transform(F.sequence(F.lit(0), F.size(F.split(head, " ")) - 1), word)
        return F.concat_ws(" ", F.when(head != "", F.array_join(words, " ")), tail)
    out = (F.when(kind == "email", email).when(kind == "domain", domain).when(kind == "ip", ip).when(kind == "ssn", digits)
           .when(kind == "card", card).when(kind == "phone", phone))
    for script in SYLLABLES:
        for gender in TITLES:
            out = out.when(kind == f"name_{gender}_{script}", name(script, gender))
    return out


def _chosen(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, surrogate of the distinct (kind, canon, head, tail): no two of
    one type with the same, and none an entity of its type."""
    kind = F.substring_index("kind", "_", 1).alias("type")  # names of all genders and scripts are one type
    taken = entities.select(kind, F.col("canon").alias("surrogate")).distinct()
    out, left = None, entities
    for draw in range(DRAWS):
        # Drawing costs far more than its few bytes tell: a partition's share each.
        spread = left.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), "canon")
        drawn = saved(spread.withColumn("draw", F.lit(draw)).withColumn("surrogate", _drawn(key)).drop("draw"), "pii-drawn")
        first = drawn.groupBy(kind, "surrogate").agg(F.min(F.struct("kind", "canon")).alias("of"))
        used = taken if out is None else taken.unionByName(out.select(kind, "surrogate"))
        good = first.join(used, ["type", "surrogate"], "left_anti").select("of.kind", "of.canon", "surrogate")
        good = saved(good, "pii-surrogates")
        out = good if out is None else out.unionByName(good)
        left = saved(drawn.drop("surrogate").join(good, ["kind", "canon"], "left_anti"), "pii-left")
        if left.isEmpty():
            return out
    raise ArithmeticError(f"entities collide after {DRAWS} draws, the last of them {DRAWS // LONGER} characters longer")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, surrogate (canonical) of the distinct (kind, canon), no two
    of one type with the same, and none an entity of its type. Neither does a
    domain or surname of the corpus stand in one."""
    entities = saved(entities.select("kind", "canon").distinct(), "pii-entities")
    kind, canon, none = F.col("kind"), F.col("canon"), F.lit(None).cast("string")
    mail = kind == "email"
    apart = F.when(mail, F.lit("@")).when(kind.startswith("name"), F.lit(" "))
    old = F.when(mail, F.substring_index(canon, "@", -1)).otherwise(F.substring_index(canon, " ", -1))
    head = F.rtrim(F.substr(canon, F.lit(1), F.length(canon) - F.length(old)), apart)
    of = F.when(mail, F.lit("domain")).otherwise(kind)
    ended = entities.where(apart.isNotNull()).select("kind", "canon", head.alias("head"), of.alias("of"), old.alias("old"))
    tails = saved(ended.select(F.col("of").alias("kind"), F.col("old").alias("canon")).distinct(), "pii-tails")
    tails = _chosen(tails.select("kind", "canon", F.col("canon").alias("head"), none.alias("tail")), key)
    tails = tails.select(F.col("kind").alias("of"), F.col("canon").alias("old"), F.col("surrogate").alias("tail"),
                         F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    ended = ended.withColumn("part", F.pmod(F.xxhash64("canon"), F.lit(PARTS)).cast("int")).join(tails, ["of", "old", "part"])
    plain = entities.where(apart.isNull()).select("kind", "canon", F.col("canon").alias("head"), none.alias("tail"))
    return _chosen(saved(plain.unionByName(ended.select("kind", "canon", "head", "tail")), "pii-parts"), key)


def _rendered(entity: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the entity's own spelling."""
    digits = F.regexp_replace(surrogate, r"\D", "")

    def laid(i: Column) -> Column:
        c = F.substr(entity, i, F.lit(1))
        before = F.length(F.regexp_replace(F.substr(entity, F.lit(1), i), r"\D", ""))
        return F.when(c.rlike("[0-9]"), F.substr(digits, before, F.lit(1))).otherwise(c)

    def cased(i: Column) -> Column:
        c = F.substr(surrogate, i, F.lit(1))
        return F.when(F.substr(entity, i, F.lit(1)).rlike("[A-Z]"), F.upper(c)).otherwise(c)

    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(entity)))
    letters = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(surrogate)))
    title = F.regexp_extract(entity, r"^(\S+ )", 1)
    held = F.length(F.regexp_replace(entity, r"\D", ""))
    return (F.when(kind.isin("ssn", "card", "phone"), F.concat(F.array_join(F.transform(places, laid), ""), F.substr(digits, held + 1)))
            .when(kind == "email", F.array_join(F.transform(letters, cased), ""))
            .when(kind == "ip", surrogate).otherwise(F.concat(title, F.initcap(surrogate))))


KINDS = ("email", "phone", "card", "ssn", "ip", "name")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` as ``row``, text (with surrogates) and counts (a map
    from each of ``KINDS`` to the entities replaced, with repeats).

    A null text stays null, and a text without entities stays as it is. Repeated
    rows are treated alike; an empty table gives no rows. Entities are found
    leftmost and do not overlap.
    """
    content = {"k1": F.xxhash64("row.text"), "k2": F.xxhash64(F.lit("content"), F.col("row.text"))}
    rows = packed(docs)
    some = F.coalesce(F.col("row.text").rlike(ANY), F.lit(False))
    found = rows.where(some).select(*[v.alias(k) for k, v in content.items()], F.regexp_extract_all("row.text", F.lit(ANY), F.lit(0)).alias("found"))
    # Copies of a text are one content.
    found = saved(found.groupBy("k1", "k2").agg(F.first("found").alias("found")), "pii-found")
    each = found.select("k1", "k2", F.posexplode("found").alias("place", "entity")).withColumn("kind", kind_of(F.col("entity")))
    each = saved(each.withColumn("canon", canon_of(F.col("entity"), F.col("kind"))), "pii-each")
    table = surrogates(each, key)
    each = each.join(table, ["kind", "canon"])
    each = each.select("k1", "k2", "place", F.substring_index("kind", "_", 1).alias("kind"),
                       _rendered(F.col("entity"), F.col("kind"), F.col("surrogate")).alias("new"))
    told = each.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("place", "kind", "new"))).alias("told"))
    told = saved(told, "pii-told")
    gaps = F.split("row.text", ANY, -1)
    text = F.array_join(F.zip_with(gaps, F.concat(F.transform("told", lambda t: t["new"]), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")

    def count(kind: str) -> Column:
        return F.size(F.filter("told", lambda t: t["kind"] == kind)).cast("long")

    counted = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*map(count, KINDS)))
    changed = rows.where(some).withColumns(content).join(told, ["k1", "k2"]).select("row", text.alias("text"), counted.alias("counts"))
    none = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*[F.lit(0).cast("long")] * len(KINDS)))
    return changed.unionByName(rows.where(~some).select("row", F.col("row.text").alias("text"), none.alias("counts")))


def pii_report(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, n_email, n_phone, n_card, n_ssn, n_ip, n_name, and the text with
    surrogates."""
    done = replace_entities(docs.select("doc_id", "text"), key)
    return done.select("row.doc_id", *[F.col("counts")[k].alias(f"n_{k}") for k in KINDS], "text")
