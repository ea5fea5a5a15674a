"""Property checks: the Spark rules against a plain-Python model of the
same rule on random inputs (small fixtures, brute force)."""

import re
from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from baobab.functions import rules
from baobab.operators import cleaning, text

ONE = StructType([StructField("id", StringType()), StructField("v", StringType())])
SETTINGS = dict(max_examples=12, deadline=None)


def _frame(spark, values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], ONE)


def _model_phone(v):
    if v is None:
        return None, None
    d = re.sub(r"[^0-9]", "", v)
    d = d[3:] if d.startswith("221") else d
    return d, bool(re.fullmatch(r"(70|75|76|77|78)[0-9]{7}", d))


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789 +-.()221", max_size=18)), max_size=15))
def test_phone_rule(spark, values):
    df = cleaning.normalize_phone(_frame(spark, values).withColumnRenamed("v", "telephone"))
    got = {r.id: (r.telephone, r.telephone_valide) for r in df.collect()}
    assert got == {str(i): _model_phone(v) for i, v in enumerate(values)}


def _model_missing(v):
    if v is None:
        return None
    t = v.strip(" ")
    return None if t == "" or t.upper() == "N/A" else t


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.sampled_from(["", " ", "N/A", "n/a", " N/a ", "x@y.fr", " a "]), st.text(alphabet="ab N/A@.", max_size=6)), max_size=15))
def test_missing_rule(spark, values):
    df = cleaning.unify_missing(_frame(spark, values).withColumnRenamed("v", "email"))
    got = {r.id: r.email for r in df.collect()}
    assert got == {str(i): _model_missing(v) for i, v in enumerate(values)}


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789 FCA/N-", max_size=12)), max_size=15))
def test_amount_rule(spark, values):
    df = _frame(spark, values).select("id", rules.amount_clean(F.col("v")).alias("a"))
    got = {r.id: r.a for r in df.collect()}

    def model(v):
        if v is None:
            return None
        d = re.sub(r"[^0-9]", "", v.strip(" "))
        return int(d) if d and int(d) < 2**63 else None

    assert got == {str(i): model(v) for i, v in enumerate(values)}


@settings(**SETTINGS)
@given(st.lists(st.text(alphabet="abcAB  \n\tée", max_size=30), max_size=8))
def test_word_count(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r.mot: r.n for r in text.word_count(df).collect()}
    exp = Counter(w for t in texts for w in re.split(r"[ \t\n\x0b\f\r]+", t.lower()) if w != "")
    assert got == dict(exp)


@settings(**SETTINGS)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from(["1", "2", "3"])),
            st.one_of(st.none(), st.text(alphabet="abAB é", max_size=3)),
            st.one_of(st.none(), st.booleans()),
        ),
        max_size=20,
    )
)
def test_dedup_survivor_is_smallest_row_nulls_first(spark, rows):
    df = spark.createDataFrame(rows, "customer_id string, email string, ok boolean")
    got = {r.customer_id: (r.email, r.ok) for r in cleaning.dedup_by_key(df.repartition(3)).collect()}

    def sort_key(v):
        # NULL first, then the value (strings by code point, False < True)
        return (v is not None, v if v is not None else "")

    exp = {}
    for cid, email, ok in rows:
        cand = (email, ok)
        cur = exp.get(cid)
        if cur is None or (sort_key(cand[0]), sort_key(cand[1])) < (sort_key(cur[0]), sort_key(cur[1])):
            exp[cid] = cand
    assert got == exp


@settings(**SETTINGS)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from(["s1", "s2", "s3", "s4"])),
            st.sampled_from(["view_product", "add_to_cart", "purchase", "signup"]),
        ),
        max_size=25,
    ),
    st.booleans(),
)
def test_funnel_flags_equal_count_distinct(spark, events, strict):
    from baobab.operators import funnel

    df = spark.createDataFrame(events, "session_id string, event_type string")
    got = funnel.funnel_counts(df, strict=strict).first()
    steps = ["view_product", "add_to_cart", "purchase"]
    seen = {}
    for sid, et in events:
        if sid is not None:
            seen.setdefault(sid, set()).add(et)
    counts = []
    for i, _ in enumerate(steps):
        need = steps[: i + 1] if strict else [steps[i]]
        counts.append(sum(1 for s in seen.values() if all(x in s for x in need)))
    assert (got.sessions, got.vues, got.paniers, got.achats) == (len(seen), *counts)


@settings(**SETTINGS)
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=10),
    st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=10),
)
def test_not_in_three_valued(spark, lk, rk):
    from baobab.operators import joins

    left = spark.createDataFrame([(k,) for k in lk], "k long")
    right = spark.createDataFrame([(k,) for k in rk], "k long")
    r = joins.not_in_count(left, right, "k").first()
    # SQL: x NOT IN (list) is TRUE only when the list is empty, or x is not NULL,
    # the list has no NULL and x is not in it
    if not rk:
        exp = len(lk)
    elif any(v is None for v in rk):
        exp = 0
    else:
        exp = sum(1 for v in lk if v is not None and v not in rk)
    assert r.n_not_in == exp
    assert r.n_anti == sum(1 for v in lk if v is None or v not in [x for x in rk if x is not None])


@settings(**SETTINGS)
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 50)), max_size=12),
    st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=8),
)
def test_join_audit_against_python(spark, left_rows, right_keys):
    from baobab.operators import joins

    left = spark.createDataFrame(left_rows, "k long, amount long")
    right = spark.createDataFrame([(k,) for k in right_keys], "k long")
    r = joins.join_audit(left, right, "k", "amount").first()
    mult = {}
    for k in right_keys:
        if k is not None:
            mult[k] = mult.get(k, 0) + 1
    m = [mult.get(k, 0) if k is not None else 0 for k, _ in left_rows]
    assert r.n_left == len(left_rows)
    assert r.n_semi == sum(1 for x in m if x > 0) and r.n_anti == sum(1 for x in m if x == 0)
    assert r.n_inner == sum(m) and r.fan_out == sum(m) - r.n_semi and r.partition_ok
    amounts = [a for _, a in left_rows]
    assert r.ca_avant == (sum(amounts) if left_rows else None)
    if any(x > 0 for x in m):
        assert r.ca_apres == sum(a * x for (_, a), x in zip(left_rows, m) if x > 0)
    assert r.ca_perdu == sum(a for (_, a), x in zip(left_rows, m) if x == 0)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(list("pqrstu")), st.integers(0, 9)), max_size=20), st.integers(1, 3))
def test_top_n_per_group_against_python(spark, rows, n):
    from baobab.operators import ranking

    df = spark.createDataFrame(rows, "g string, name string, v long")
    got = sorted((r.g, r.rang, r.name, r.v) for r in ranking.top_n_per_group(df, ["g"], "v", n, ["name"]).collect())
    exp = []
    for g in sorted({r[0] for r in rows}):
        ranked = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:n]
        exp += [(g, i + 1, r[1], r[2]) for i, r in enumerate(ranked)]
    assert got == sorted(exp)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["1", "2"])), st.one_of(st.none(), st.sampled_from(["", " ", "N/A", "a@b.fr"])), st.one_of(st.none(), st.sampled_from(["Dakar", "Thies"]))), max_size=12))
def test_quality_profile_against_python(spark, rows):
    from baobab.operators import quality

    df = spark.createDataFrame(rows, "customer_id string, email string, ville string")
    prof = {r.metric: r.value for r in quality.quality_profile(df).collect()}
    assert prof["n_rows"] == len(rows)
    assert prof["n_exact_duplicates"] == len(rows) - len(set(rows))
    assert prof["n_distinct_cities"] == len({r[2] for r in rows if r[2] is not None})
    assert prof["n_null_email"] == sum(1 for r in rows if r[1] is None)
    assert prof["n_email_pseudo_missing"] == sum(1 for r in rows if r[1] is None or r[1].strip(" ") in ("", "N/A"))


# Java's "$" (no MULTILINE) also matches before one final line terminator
_JAVA_EMAIL = re.compile(r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}(?:\r\n|[\n\r\u0085\u2028\u2029])?\Z")


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab@.Z_-% \n\r", max_size=10), st.sampled_from(["a@b.fr", " A@B.COM ", "a@b..com", "a@b.fr\n", "a@b"])), max_size=15))
def test_email_rule(spark, values):
    df = cleaning.normalize_email(_frame(spark, values).withColumnRenamed("v", "email"))
    got = {r.id: (r.email, r.email_valide) for r in df.collect()}

    def model(v):
        if v is None:
            return None, None
        e = v.strip(" ").lower()
        return e, bool(_JAVA_EMAIL.search(e))

    assert got == {str(i): model(v) for i, v in enumerate(values)}


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["x", "y"])), st.one_of(st.none(), st.sampled_from(["p", "q", "r"]))), max_size=15))
def test_value_counts_against_counter(spark, rows):
    from baobab.operators import quality

    df = spark.createDataFrame(rows, "a string, b string")
    got = {(r.column_name, r.value): r.n for r in quality.value_counts(df, ["a", "b"]).collect()}
    exp = Counter([("a", r[0]) for r in rows] + [("b", r[1]) for r in rows])
    assert got == dict(exp)


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBéÈç-Ö ō", max_size=12)), max_size=12))
def test_city_rule(spark, values):
    import unicodedata

    df = cleaning.normalize_city(_frame(spark, values).withColumnRenamed("v", "ville"))
    got = {r.id: (r.ville, r.ville_norm) for r in df.collect()}

    def fold(ch):
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        ok = 0xC0 <= ord(ch) <= 0x17F and len(base) == 1 and base.isascii() and base.isalpha()
        return base if ok else ch

    def model(v):
        if v is None:
            return None, None
        t = v.strip(" ").lower()
        display = " ".join(w[:1].upper() + w[1:] for w in t.split(" "))  # a word starts after a space only
        return display, "".join(fold(c) for c in display.strip(" ").lower())

    assert got == {str(i): model(v) for i, v in enumerate(values)}


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(1900, 2100), st.integers(0, 13), st.integers(0, 32)), max_size=15))
def test_birth_date_rule(spark, parts):
    import datetime as dt

    values = [f"{y:04d}-{m:02d}-{d:02d}" for y, m, d in parts]
    df = cleaning.validate_birth_date(_frame(spark, values).withColumnRenamed("v", "date_naissance"), as_of="2025-06-30")
    got = {r.id: r.date_naissance for r in df.collect()}

    def model(y, m, d):
        try:
            day = dt.date(y, m, d)
        except ValueError:  # not a real day
            return None
        return day if dt.date(1920, 1, 1) <= day <= dt.date(2025, 6, 30) else None

    assert got == {str(i): model(*p) for i, p in enumerate(parts)}


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 5000)), min_size=1, max_size=15), st.integers(0, 3))
def test_pct_rounds_half_up(spark, pairs, digits):
    from decimal import ROUND_HALF_UP, Decimal

    df = spark.createDataFrame(pairs, "a long, b long").select(rules.pct(F.col("a"), F.col("b"), digits).alias("p"))
    got = [r.p for r in df.collect()]

    def model(a, b):
        if b == 0:
            return None
        x = a * 100.0 / b
        return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))

    assert got == [model(a, b) for a, b in pairs]


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["mobile_app", "web"]), st.sampled_from(["livree", "livrée", "annulee"])), max_size=12))
def test_month_filter_is_half_open(spark, rows):
    import datetime as dt

    from baobab.operators import kpi

    stamps = [dt.datetime(2025, 11, 30, 23, 59, 59), dt.datetime(2025, 12, 1, 0, 0), dt.datetime(2025, 12, 31, 23, 59, 59), dt.datetime(2026, 1, 1, 0, 0)]
    data = [(i, 1, st_, ch, "100", stamps[t]) for i, (t, ch, st_) in enumerate(rows)]
    df = spark.createDataFrame(data, "order_id long, customer_id long, statut string, canal string, montant_total_fcfa string, date_commande timestamp_ntz")
    got = kpi.delivered_in_month(kpi.prepare_orders(df), "2025-12").first().nb_commandes
    exp = sum(1 for t, ch, st_ in rows if t in (1, 2) and ch == "mobile_app" and st_ in ("livree", "livrée"))
    assert got == exp


@settings(**SETTINGS)
@given(
    st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["livree", "livrée", "annulee"]), st.one_of(st.none(), st.integers(0, 900))), max_size=20),
    st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["R1", "R2"])), max_size=10),
)
def test_revenue_by_region_equals_inner_join(spark, orders, customers):
    from collections import defaultdict

    from baobab.operators import kpi

    o = spark.createDataFrame(
        [(i, c, s, None if a is None else str(a)) for i, (c, s, a) in enumerate(orders)],
        "order_id long, customer_id long, statut string, montant_total_fcfa string",
    )
    c = spark.createDataFrame(customers, "customer_id long, region string")  # missing and repeated keys allowed
    got = {r.region: (r.ca_fcfa, r.nb_commandes) for r in kpi.revenue_by_region(kpi.prepare_orders(o), c).collect()}
    ca, nb = defaultdict(lambda: None), defaultdict(int)
    for cid, s, a in orders:
        if s not in ("livree", "livrée"):
            continue
        for ccid, reg in customers:  # SQL inner join semantics, row by row
            if ccid == cid:
                nb[reg] += 1
                if a is not None:
                    ca[reg] = (ca[reg] or 0) + a
    assert got == {reg: (ca[reg], nb[reg]) for reg in nb}


@settings(**SETTINGS)
@given(
    st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(1, 4), st.integers(1, 50)), max_size=20),
    st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["livree", "annulee"])), max_size=6),
    st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["Dakar", "Thies"])), max_size=6),
)
def test_line_revenue_equals_row_level_joins(spark, lines, orders, customers):
    from collections import defaultdict

    from baobab.operators import kpi

    items = spark.createDataFrame(lines, "order_id long, product_id long, quantite long, prix_unitaire_fcfa long")
    o = kpi.prepare_orders(spark.createDataFrame(
        [(oid, oid % 4, s, "1") for oid, s in orders], "order_id long, customer_id long, statut string, montant_total_fcfa string"
    ))
    c = spark.createDataFrame(customers, "customer_id long, ville string")
    p = spark.createDataFrame([(k, "CAT" + str(k % 2)) for k in range(4)], "product_id long, categorie string")
    got = {(r.ville, r.categorie): r.ca_fcfa for r in kpi.revenue_by(items, o, c, p, ("ville",), ("categorie",)).collect()}
    exp = defaultdict(int)
    for oid, pid, q, pr in lines:
        for ooid, s in orders:
            if ooid != oid or s != "livree":
                continue
            for cid, ville in customers:
                if cid == ooid % 4 and pid < 4:
                    exp[(ville, "CAT" + str(pid % 2))] += q * pr
    assert got == dict(exp)


@settings(**SETTINGS)
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 50))), max_size=12),
    st.lists(st.integers(0, 3), max_size=6),
)
def test_sentinel_with_null_amounts(spark, left_rows, right_keys):
    from baobab.operators import joins

    left = spark.createDataFrame(left_rows, "k long, amount long")
    right = spark.createDataFrame([(k,) for k in right_keys], "k long")
    r = joins.sentinel(left, right, "k", "amount").first()

    def sql_sum(xs):  # SUM ignores NULLs and is NULL when nothing is left
        xs = [x for x in xs if x is not None]
        return sum(xs) if xs else None

    mult = {k: right_keys.count(k) for k in set(right_keys)}
    joined = [a for k, a in left_rows if k is not None for _ in range(mult.get(k, 0))]
    lost = [a for k, a in left_rows if k is None or mult.get(k, 0) == 0]
    assert r.ca_avant == sql_sum(a for _, a in left_rows)
    assert r.ca_apres == sql_sum(joined)
    assert r.ca_perdu == (sql_sum(lost) or 0)


@settings(**SETTINGS)
@given(
    st.lists(st.sampled_from(["livree", "annulee", "en_cours"]), max_size=15),
    st.dictionaries(st.integers(0, 14), st.sampled_from(["Wave", "carte"]), max_size=15),
)
def test_cancel_rate_with_unpaid_orders(spark, statuses, paid):
    from decimal import ROUND_HALF_UP, Decimal

    from baobab.operators import kpi

    o = kpi.prepare_orders(spark.createDataFrame(
        [(i, 1, s, "10") for i, s in enumerate(statuses)], "order_id long, customer_id long, statut string, montant_total_fcfa string"
    ))
    pay = spark.createDataFrame(list(paid.items()), "order_id long, methode string")
    got = {r.methode: (r.nb_total, r.nb_annulees, r.taux_annulation_pct) for r in kpi.cancel_rate(o, pay).collect()}
    groups = {}
    for i, s in enumerate(statuses):
        g = groups.setdefault(paid.get(i), [0, 0])  # no payment row: NULL method (left join)
        g[0] += 1
        g[1] += s == "annulee"

    def pct(a, b):
        return float(Decimal(repr(a * 100.0 / b)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))

    assert got == {m: (n, c, pct(c, n)) for m, (n, c) in groups.items()}


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123 FCA/", max_size=8)), max_size=15))
def test_amount_polluted_counts(spark, values):
    from baobab.operators import quality

    df = spark.createDataFrame([(v,) for v in values], "montant_total_fcfa string")
    r = quality.amount_polluted(df).first()
    bad = [v for v in values if v is not None and not re.fullmatch(r"[0-9]+", v)]
    assert (r.n_rows, r.n_polluted, r.n_null, r.n_distinct_polluted) == (
        len(values), len(bad), sum(v is None for v in values), len(set(bad)))


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.sampled_from(["Wave", "Orange Money", "carte", "especes"])), min_size=1, max_size=20))
def test_payment_share(spark, methods):
    from decimal import ROUND_HALF_UP, Decimal

    from baobab.operators import kpi

    df = spark.createDataFrame([(i, m) for i, m in enumerate(methods)], "order_id long, methode string")
    got = {r.methode: (r.nb, r.part_pct) for r in kpi.payment_share(df).collect()}
    cnt = Counter(methods)

    def pct(a, b):
        return float(Decimal(repr(a * 100.0 / b)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))

    assert got == {m: (n, pct(n, len(methods))) for m, n in cnt.items()}
    mm = kpi.grouped_payment_share(df).first().part_mobile_money_pct
    assert mm == pct(sum(cnt[m] for m in ("Wave", "Orange Money")), len(methods))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 28), st.sampled_from(["livree", "LIVRÉE ", "annulee"]), st.integers(0, 99)), max_size=15))
def test_monthly_revenue(spark, rows):
    import datetime as dt
    from collections import defaultdict

    from baobab.operators import kpi

    data = [(i, 1, s, str(a), dt.datetime(2025, m, d, 12, 0)) for i, (m, d, s, a) in enumerate(rows)]
    df = spark.createDataFrame(data, "order_id long, customer_id long, statut string, montant_total_fcfa string, date_commande timestamp_ntz")
    got = {r.mois: (r.nb_commandes, r.ca_fcfa) for r in kpi.monthly_revenue(kpi.prepare_orders(df)).collect()}
    exp = defaultdict(lambda: [0, 0])
    for m, d, s, a in rows:
        if s.strip().lower() in ("livree", "livrée"):
            exp[dt.date(2025, m, 1)][0] += 1
            exp[dt.date(2025, m, 1)][1] += a
    assert got == {k: tuple(v) for k, v in exp.items()}
