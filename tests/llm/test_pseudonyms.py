import datetime as dt
import hashlib
import re

from pyspark.sql import functions as F

from qualis.llm.pseudonyms import KINDS, permute, pseudonymise


def _luhn_ok(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def test_permutation_is_one_to_one(spark):
    pairs = spark.range(17 * 23).select(F.floor(F.col("id") / 23).alias("l"), (F.col("id") % 23).alias("r"))
    a, b = F.lit(17).cast("long"), F.lit(23).cast("long")
    got = [tuple(r.p) for r in pairs.select(permute(F.col("l"), F.col("r"), a, b, F.lit("k"), "t").alias("p")).collect()]
    other = [tuple(r.p) for r in pairs.select(permute(F.col("l"), F.col("r"), a, b, F.lit("k2"), "t").alias("p")).collect()]
    assert len(set(got)) == 17 * 23 and all(0 <= x < 17 and 0 <= y < 23 for x, y in got) and got != other


VALUES = {
    "card": "4111 1111 1111 1111", "ssn": "123-45-6789", "ip": "42.144.35.254", "date": "1987-02-28", "date_dmy": "31.12.1999", "date_mdy": "02/29/2000",
    "phone": "+49 (30) 1234-5678", "email": "Anna.b_7@mail8.example.com",
}


def _format(s):
    return re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", s)))


def test_values_keep_format_and_validity_and_stay_linked(spark):
    rows = [(i, f"é {v} and again {v}, end.", 5) for i, v in enumerate(VALUES.values())]
    rows += [(100, "; ".join(VALUES.values()), 5), (101, None, 5), (102, "", 5), (102, "", 5), (None, "nothing", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_card int")
    got = {r.doc_id: r for r in pseudonymise(docs, "secret").collect()}
    listed = dict(zip(VALUES, got[100].text.split("; ")))
    for i, (kind, value) in enumerate(VALUES.items()):
        new = re.fullmatch(r"é (.*) and again (.*), end\.", got[i].text)
        assert new[1] == new[2] == listed[kind] != value and got[i][f"n_{kind}"] == 2, kind
        assert sum(got[i][f"n_{k.name}"] for k in KINDS) == 2
        if kind != "ip":
            assert _format(new[1]).split("@")[0] == _format(value).split("@")[0]
    assert _luhn_ok(re.sub(r"\D", "", listed["card"]))
    assert all(int(o) < 256 for o in listed["ip"].split("."))
    dt.date.fromisoformat(listed["date"]), dt.datetime.strptime(listed["date_dmy"], "%d.%m.%Y"), dt.datetime.strptime(listed["date_mdy"], "%m/%d/%Y")
    assert listed["email"].endswith("@mail8.example.com") and listed["phone"].startswith("+49")
    assert got[101].text == got[102].text == "" and got[None].text == "nothing"
    assert pseudonymise(docs.limit(0), "secret").count() == 0


def test_invalid_values_stay(spark):
    texts = ["4111 1111 1111 1112", "000-12-3456", "300.1.2.3", "2023-02-30", "1.2.3.4.5", "x4111111111111111", "a 1234567890123 b", "99/99/2000"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.text for r in pseudonymise(docs, "secret").orderBy("doc_id").collect()] == texts


def test_query_replaces_every_planted_value(spark):
    from qualis.llm import pseudonyms

    path = "/root/testdata/sf0.01"
    old = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    new = {r.doc_id: r for r in pseudonyms.query(spark, path).collect()}
    assert old.keys() == new.keys()
    changed = 0
    for d, t in old.items():
        cards = [c for c in re.findall(r"(?<![0-9A-Za-z])[0-9]{16}(?![0-9A-Za-z])", t) if _luhn_ok(c)]
        mails = re.findall(r"[a-z.0-9]+@[a-z0-9.]+\.com", t)
        ips = re.findall(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])", t)
        assert not any(x in new[d].text for x in [*cards, *mails, *ips]) and len(new[d].text) >= len(t) - 12 * len(ips)
        changed += new[d].text != t
        if not cards and not mails and not ips and not re.search("[0-9]", t):
            assert new[d].text == t
    assert changed > 10


def test_cards_are_found_beside_other_digits(spark):
    card = "4111 1111 1111 1111"
    texts = [f"a {card} 123", f"pay 2 {card} now", "card-4111111111111111", "a/4111111111111111/12", f"{card} 12ab", f"{card} 4242 4242 4242 4242", "12 " * 30 + "x",
             "7" * 9000, "1.4111111111111111"]
    got = [(r.text, r.n_card) for r in pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "secret").orderBy("doc_id").collect()]
    new = got[0][0][2:-4]
    assert new != card and _luhn_ok(new.replace(" ", "")) and got[0] == (f"a {new} 123", 1)
    assert got[1] == (f"pay 2 {new} now", 1)
    assert got[2] == (f"card-{new.replace(' ', '')}", 1) and got[3] == (f"a/{new.replace(' ', '')}/12", 1) and got[4] == (f"{new} 12ab", 1)
    assert got[5][0].startswith(new + " ") and "4242 4242 4242 4242" not in got[5][0] and got[5][1] == 2
    assert re.sub("[0-9]", "0", got[6][0]) == "00 " * 30 + "x" and got[7:] == [(t, 0) for t in texts[7:]]


def test_national_phones_and_date_times(spark):
    texts = ["+1 (217) 555-7713", "(217) 555-7713", "217-555-7713", "1-217-555-7713", "1990-05-12T00:00:00", "1990-05-12", "1990-05-12Thursday"]
    got = [r.text for r in pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "secret").orderBy("doc_id").collect()]
    digits = [re.sub("[^0-9]", "", t) for t in got]
    assert got[0] != texts[0] and digits[0] == "1" + digits[1] == "1" + digits[2] == digits[3] and list(map(_format, got)) == list(map(_format, texts))
    assert got[4] == got[5] + "T00:00:00" and got[5] != texts[5] and got[6] == texts[6]


def _inverse(left, right, a, b, key, tweak):
    """The permutation undone, by hashlib alone."""
    def keyed(modulus, *parts):
        return int(hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()[:15], 16) % modulus
    for i in range(5, 0, -1):
        right = (right - keyed(b, key, tweak, i, "r", left, a, b)) % b
        left = (left - keyed(a, key, tweak, i, "l", right, a, b)) % a
    return left, right


def test_pseudonyms_are_undone_with_the_key_only(spark):
    import random

    draw = random.Random(3)
    days = [(dt.date(1900, 1, 1) + dt.timedelta(days=draw.randrange(17 * 4297))).isoformat() for _ in range(40)]
    hosts = [".".join(str(draw.randrange(256)) for _ in range(4)) for _ in range(40)]
    phones = [f"+49 {draw.randrange(10**8, 10**9)}" for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(days + hosts + phones)]
    got = [r.text for r in sorted(pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "secret").collect(), key=lambda r: r.doc_id)]

    def date(text, key):
        n = (dt.date.fromisoformat(text) - dt.date(1900, 1, 1)).days
        left, right = _inverse(n // 4297, n % 4297, 17, 4297, key, "date")
        return (dt.date(1900, 1, 1) + dt.timedelta(days=left * 4297 + right)).isoformat()

    def host(text, key):
        o = list(map(int, text.split(".")))
        left, right = _inverse(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip")
        return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"

    def phone(text, key):
        digits = text[4:]
        half = len(digits) // 2
        left, right = _inverse(int(digits[:half]), int(digits[half:]), 10**half, 10**(len(digits) - half), key, "phone")
        return f"{text[:4]}{left:0{half}d}{right:0{len(digits) - half}d}"

    undo = [date] * 40 + [host] * 40 + [phone] * 40
    assert [f(t, "secret") for f, t in zip(undo, got)] == [v for _, v in rows]
    assert sum(f(t, "other") == v for f, t, (_, v) in zip(undo, got, rows)) <= 2
