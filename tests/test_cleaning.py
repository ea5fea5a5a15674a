"""Cleaning rules C1 - C7 as tables of cases, and the cases at their edges."""

import datetime as dt

from pyspark.sql.types import StringType, StructField, StructType
from pyspark.testing import assertDataFrameEqual

from baobab.functions.text import accent_table
from baobab.operators import cleaning

S2 = StructType([StructField("customer_id", StringType()), StructField("email", StringType())])


def _one_column(spark, name, values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], f"customer_id string, {name} string")


def _by_position(df, *cols):
    return [tuple(r[c] for c in cols) for r in sorted(df.collect(), key=lambda r: int(r.customer_id))]


def test_unify_missing(spark):
    cases = {"awa@courrier.sn": "awa@courrier.sn", "\t": "\t", "N/A ": None, " n/A": None, "": None, "      ": None, "NA": "NA"}
    got = cleaning.unify_missing(_one_column(spark, "email", [*cases, None]))
    assert [v for (v,) in _by_position(got, "email")] == [*cases.values(), None]


def test_normalize_email(spark):
    cases = {
        "MODOU.Fall+1@Poste.SN ": ("modou.fall+1@poste.sn", True),
        "modou@poste": ("modou@poste", False),
        "deux@@poste.sn": ("deux@@poste.sn", False),
        "a b@poste.sn": ("a b@poste.sn", False),
        "x_%y@sous.domaine.org": ("x_%y@sous.domaine.org", True),
        "fin@poste.s": ("fin@poste.s", False),
    }
    got = cleaning.normalize_email(_one_column(spark, "email", [*cases, None]))
    assert _by_position(got, "email", "email_valide") == [*cases.values(), (None, None)]  # None: not assessable


def test_email_tab_is_not_trimmed(spark):
    # trim strips spaces only: a tab-padded address stays invalid
    df = spark.createDataFrame([("1", "\tclient@mail.com")], S2)
    r = cleaning.normalize_email(df).first()
    assert r.email == "\tclient@mail.com" and r.email_valide is False


def test_normalize_city(spark):
    cases = {
        "ziguinCHOR  ": ("Ziguinchor", "ziguinchor"),
        " guédiawaye": ("Guédiawaye", "guediawaye"),
        "GUEDIAWAYE": ("Guediawaye", "guediawaye"),
        "keur massar nord": ("Keur Massar Nord", "keur massar nord"),
        "Foundiougne-Île": ("Foundiougne-île", "foundiougne-ile"),  # a word starts after a space only
        "": ("", ""),
    }
    got = cleaning.normalize_city(_one_column(spark, "ville", [*cases, None]))
    assert _by_position(got, "ville", "ville_norm") == [*cases.values(), (None, None)]


def test_accent_table_is_one_to_one():
    src, dst = accent_table()
    assert len(src) == len(dst) == 162
    assert all(len(c) == 1 and c.isascii() for c in dst)
    assert "Æ" not in src and "ß" not in src and "é" in src and "ſ" in src


def test_normalize_phone(spark):
    cases = {
        "(76) 555 40 21": ("765554021", True),
        "221755554021": ("755554021", True),
        "+221-70.555.40.21": ("705554021", True),
        "77555402": ("77555402", False),
        "7755540211": ("7755540211", False),
        "335554021": ("335554021", False),  # no mobile prefix
        "00221765554021": ("00221765554021", False),  # 00221 is not the country-code form
        "221 221 765554021": ("221765554021", False),  # one country code is removed, not two
        "aucun": ("", False),
    }
    got = cleaning.normalize_phone(_one_column(spark, "telephone", [*cases, None]))
    assert _by_position(got, "telephone", "telephone_valide") == [*cases.values(), (None, None)]


def test_validate_birth_date(spark):
    cases = {
        "1964-02-29": dt.date(1964, 2, 29),
        "1963-02-29": None,  # no such day
        "1919-12-30": None,
        "1920-01-01": dt.date(1920, 1, 1),  # the first day counts
        "2024-11-05": dt.date(2024, 11, 5),  # as does the last
        "2024-11-06": None,
        "1964/02/28": None,
        "64-02-28": None,
        "": None,
    }
    got = cleaning.validate_birth_date(_one_column(spark, "date_naissance", [*cases, None]), as_of="2024-11-05")
    assert [v for (v,) in _by_position(got, "date_naissance")] == [*cases.values(), None]


def test_birth_date_default_is_today(spark):
    df = spark.createDataFrame([("1", "2099-01-01"), ("2", "1990-01-01")], ["customer_id", "date_naissance"])
    out = {r.customer_id: r.date_naissance for r in cleaning.validate_birth_date(df).collect()}
    assert out["1"] is None and out["2"] == dt.date(1990, 1, 1)


def test_dedup_customers(spark):
    data = [(k, f"{k}{v}@poste.sn", "Louga") for k in "abcd" for v in (0, 0, 1)]
    df = spark.createDataFrame(data, ["customer_id", "email", "ville"])
    assert sorted(map(tuple, cleaning.dedup_customers(df).collect())) == [(k, f"{k}0@poste.sn", "Louga") for k in "abcd"]


def test_dedup_survivor_is_deterministic(spark):
    df = spark.createDataFrame(
        [("1", "b@x.com", "Thies"), ("1", "a@x.com", "Dakar"), ("1", None, "Zz"), (None, "q", "A"), (None, "p", "B")],
        ["customer_id", "email", "ville"],
    )
    rows = {r.customer_id: (r.email, r.ville) for r in cleaning.dedup_customers(df.repartition(3)).collect()}
    assert rows["1"] == (None, "Zz")  # NULLs first, then lexicographic
    assert rows[None] == ("p", "B")  # NULL ids collapse to one row
    assert len(rows) == 2


def test_clean_customers_chain(spark):
    schema = "customer_id string, prenom string, nom string, email string, telephone string, ville string, region string, date_naissance string, date_inscription string"
    same = ("Awa", "Sarr")
    df = spark.createDataFrame(
        [
            ("k7", *same, "AWA@POSTE.SN", "+221 76 555 40 21", "louga ", "Louga", "1971-05-04", "2022-02-02"),
            ("k7", *same, " awa@poste.sn", "765554021", " LOUGA", "Louga", "1971-05-04", "2022-02-02"),
            ("k8", "Binta", "Ndao", "n/a", "33 555 40 21", "guédiawaye", "Dakar", "2031-05-04", "2022-02-03"),
        ],
        schema,
    )
    got = {r.customer_id: r for r in cleaning.clean_customers(df, as_of="2024-11-05").collect()}
    assert set(got) == {"k7", "k8"}  # the two spellings of k7 are equal once cleaned
    k7, k8 = got["k7"], got["k8"]
    assert (k7.email, k7.email_valide, k7.telephone, k7.telephone_valide) == ("awa@poste.sn", True, "765554021", True)
    assert (k7.ville, k7.ville_norm, k7.date_naissance) == ("Louga", "louga", dt.date(1971, 5, 4))
    assert (k8.email, k8.email_valide, k8.telephone_valide, k8.ville_norm, k8.date_naissance) == (
        None, None, False, "guediawaye", None,
    )


def test_cleaning_is_idempotent(spark):
    df = spark.createDataFrame(
        [("1", " A@B.COM ", " thiès ", "+221 77 123 45 67")], ["customer_id", "email", "ville", "telephone"]
    )
    once = df.transform(cleaning.unify_missing).transform(cleaning.normalize_email).transform(cleaning.normalize_city).transform(cleaning.normalize_phone)
    twice = once.transform(cleaning.unify_missing).transform(cleaning.normalize_email).transform(cleaning.normalize_city).transform(cleaning.normalize_phone)
    assertDataFrameEqual(once, twice)


def test_phone_rule_not_idempotent_on_doubled_prefix(spark):
    # one 221 is removed per pass: a doubled country code changes on re-run
    df = spark.createDataFrame([("1", "221221771234567")], ["customer_id", "telephone"])
    once = cleaning.normalize_phone(df)
    twice = cleaning.normalize_phone(once.drop("telephone_valide"))
    assert once.first().telephone == "221771234567" and once.first().telephone_valide is False
    assert twice.first().telephone == "771234567" and twice.first().telephone_valide is True


def test_birth_date_changes_type(spark):
    df = spark.createDataFrame([("1", "1990-01-01")], ["customer_id", "date_naissance"])
    assert dict(cleaning.validate_birth_date(df, as_of="2025-01-01").dtypes)["date_naissance"] == "date"
