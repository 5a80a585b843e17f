"""Normality by Shapiro-Francia and Mann-Whitney with exact small groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.operators import exact_tests
from reviewloom.queries.base import query, table
from reviewloom.queries.measures import _P_OF_Z, _Z, rounded


def _poly(terms, x):
    out = repr(terms[0])
    for t in terms[1:]:
        out = f"({out}::double * {x} + {t!r}::double)"
    return out


def _quantile(p):
    """SQL of the normal quantile."""
    q, r = f"({p} - 0.5::double)", f"(({p} - 0.5::double) * ({p} - 0.5::double))"
    t = f"sqrt(-2 * ln(least({p}, 1 - {p})))"
    ratio = lambda parts, x: f"({_poly(parts[0], x)} / {_poly(parts[1], x)})"
    tail = ratio(exact_tests._TAIL, t)
    return f"case when least({p}, 1 - {p}) >= 0.02425 then {q} * {ratio(exact_tests._CENTRE, r)} when {p} < 0.5 then {tail} else -({tail}) end"


@query(
    "normality_sf",
    f"""with v as (select event_type, value as x, count(*) as c from events where value is not null group by all),
      r as (select *, sum(c) over (partition by event_type order by x rows unbounded preceding) - c + (c + 1) / 2.0::double as rank,
        sum(c) over (partition by event_type) as n from v),
      s as (select event_type, n, x, rank, (rank - 0.375::double) / (n + 0.25::double) as p from r),
      m as (select s.event_type, s.n, e.value as x, {_quantile('s.p')} as m from s join events e on e.event_type = s.event_type and e.value = s.x),
      w as (select event_type, max(n)::bigint as n, power(corr(x, m), 2) as w from m group by event_type),
      z as (select *, case when n between 5 and 5000 and w < 1 then (ln(1 - w) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n))))
        / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))) end as z from w)
    select event_type, n, round(w, 8) as w, round(z, 4) as z, z < 1.6448536269514722 as is_normal from z""",
)
def normality_sf(spark, d):
    out = exact_tests.shapiro_francia(table(spark, d, "events"), ["event_type"], "value").drop("p_value")
    return out.withColumn("w", F.round("w", 8)).withColumn("z", F.round("z", 4))


# A twin of the counting recurrence: ways(rows, taken, sum) by offering one more rank at a time.
_WAYS = """ways(n, j, s, ways) as (
    select 0, 0, 0, 1::double
    union all
    select n + 1, nj, ns, sum(ways) from (
        select n, j as nj, s as ns, ways from ways where n < 80 union all select n, j + 1, s + n + 1, ways from ways where n < 80 and j < 8)
    group by n, nj, ns)"""

_SIDES = "(select s_nationkey as k, case when s_suppkey % 5 = 0 then 1 else 2 end as g, round(s_acctbal, 2) as x from supplier)"


@query(
    "mann_whitney_exact",
    f"""with recursive {_WAYS},
      v as (select k, x, count(*) filter (g = 1) as a, count(*) as c from {_SIDES} group by k, x),
      o as (select *, sum(c) over (partition by k order by x rows unbounded preceding) as upto from v),
      t as (select k, sum(a) as n1, sum(c - a) as n2, sum(a * (upto - c + (c + 1) / 2.0::double)) as r1, sum(c::double * c * c - c) as ties from o group by k),
      w as (select k, n1::bigint as n1, n2::bigint as n2, r1 - n1 * (n1 + 1) / 2.0::double as u, ties, (n1 + n2)::double as n from t where n1 > 0 and n2 > 0),
      z as (select *, {_Z} as z, ties = 0 and least(n1, n2) <= 8 and n1 * n2 <= 2000 as exact from w),
      e as (select z.k, least(1.0, 2 * sum(ways) filter (s - j * (j + 1) / 2 >= greatest(u, n1 * n2 - u)) / sum(ways)) as p
        from z join ways on ways.n = n1 + n2 and j = least(n1, n2) group by z.k),
      p as (select z.*, case when exact then round(e.p, 4) else {_P_OF_Z} end as p_value from z left join e on e.k = z.k)
    select k as s_nationkey, n1, n2, u, exact, p_value from p""",
)
def mann_whitney_exact(spark, d):
    """Account balances of every fifth supplier against the others, by nation: few rows, mostly without ties."""
    rows = table(spark, d, "supplier").select("s_nationkey", (F.col("s_suppkey") % 5 == 0).cast("int").alias("fifth"), F.round("s_acctbal", 2).alias("x"))
    return rounded(exact_tests.mann_whitney_by(rows, ["s_nationkey"], "fifth", "x").drop("significant"), "p_value", digits=4)
