"""The few spellings in which Spark SQL and the oracle's SQL differ, one method each.

Queries are stated once over these; each engine gets its own text. The differences that change
results are spelt out here and nowhere else: tuples in distinct counts keep nulls, latest-value
aggregates skip null values, quantiles are exact and linear, and null order is always explicit.
"""

from __future__ import annotations

TZ = "Europe/Stockholm"


class Spark:
    """Spark SQL under a UTC session."""

    name = "spark"

    def quantile(self, x: str, p: float, where: str) -> str:
        return f"percentile({x}, {p}) FILTER (WHERE {where})"

    def tup(self, *xs: str) -> str:
        return f"struct({', '.join(xs)})"

    def month(self, d: str) -> str:
        return f"date_format({d}, 'yyyy-MM')"

    def weekday(self, d: str) -> str:
        return f"weekday({d})"

    def day_type(self, d: str) -> str:
        return f"CASE WHEN {self.weekday(d)} = 5 THEN 'saturday' WHEN {self.weekday(d)} = 6 THEN 'sunday' ELSE 'weekday' END"

    def day_epoch(self, d: str) -> str:
        return f"(unix_date({d}) * 86400L)"

    def ts_epoch(self, ts: str) -> str:
        return f"(unix_date(cast({ts} AS date)) * 86400L + hour({ts}) * 3600 + minute({ts}) * 60 + cast(floor(second({ts})) AS bigint))"

    def explode(self, *xs: str) -> str:
        return f"explode(array({', '.join(xs)}))"

    def explode_if(self, cond: str, a: str, b: str) -> str:
        return f"explode(CASE WHEN {cond} THEN array({a}, {b}) ELSE array({a}) END)"

    def list_by(self, x: str, key: str, sep: str = ",") -> str:
        return f"array_join(transform(array_sort(collect_list(struct({key} AS k, cast({x} AS string) AS v))), e -> e.v), '{sep}')"

    def distinct_list(self, x: str) -> str:
        return f"array_join(array_sort(collect_set(cast({x} AS string))), ',')"

    def latest(self, v: str, k: str) -> str:
        return f"max_by({v}, {k}) FILTER (WHERE {v} IS NOT NULL)"

    def earliest(self, v: str, k: str) -> str:
        return f"min_by({v}, {k}) FILTER (WHERE {v} IS NOT NULL)"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} div {b})"

    def local(self, e: str) -> str:
        return f"date_format(from_utc_timestamp(timestamp_seconds({e}), '{TZ}'), \"yyyy-MM-dd'T'HH:mm:ss\")"

    def local_date(self, e: str) -> str:
        return f"cast(from_utc_timestamp(timestamp_seconds({e}), '{TZ}') AS date)"

    def local_hour(self, e: str) -> str:
        return f"cast(hour(from_utc_timestamp(timestamp_seconds({e}), '{TZ}')) AS int)"

    def utc_of(self, day: str, hours: int) -> str:
        return f"unix_seconds(to_utc_timestamp(timestamp_seconds(unix_date({day}) * 86400L + {hours * 3600}), '{TZ}'))"

    def last_day(self, month: str) -> str:
        return f"day(last_day(to_date(concat({month}, '-01'))))"

    def text(self, x: str) -> str:
        return f"cast({x} AS string)"

    def day(self, text: str) -> str:
        return f"DATE '{text}'"

    def element(self, x: str, i: int) -> str:
        return f"cast(element_at({x}, {i}) AS double)"

    def array_of(self, x: str, key: str) -> str:
        return f"array_sort(collect_list({key}))"

    def part(self, x: str, sep: str, n: int) -> str:
        return f"split_part({x}, '{sep}', {n})"

    def pad2(self, x: str) -> str:
        return f"lpad(cast({x} AS string), 2, '0')"

    def double(self, x: str) -> str:
        return f"cast({x} AS double)"

    def same(self, a: str, b: str) -> str:
        return f"{a} <=> {b}"


class Duck(Spark):
    """The oracle's dialect."""

    name = "duck"

    def quantile(self, x, p, where):
        return f"quantile_cont({x}, {p}) FILTER (WHERE {where})"

    def tup(self, *xs):
        return f"({', '.join(xs)})"

    def month(self, d):
        return f"strftime({d}, '%Y-%m')"

    def weekday(self, d):
        return f"(isodow({d}) - 1)"

    def day_epoch(self, d):
        return f"cast(epoch({d}) AS bigint)"

    def ts_epoch(self, ts):
        return f"cast(floor(epoch({ts})) AS bigint)"

    def explode(self, *xs):
        return f"unnest([{', '.join(xs)}])"

    def explode_if(self, cond, a, b):
        return f"unnest(CASE WHEN {cond} THEN [{a}, {b}] ELSE [{a}] END)"

    def list_by(self, x, key, sep=","):
        return f"string_agg(cast({x} AS varchar), '{sep}' ORDER BY {key})"

    def distinct_list(self, x):
        return f"string_agg(DISTINCT cast({x} AS varchar), ',' ORDER BY cast({x} AS varchar))"

    def latest(self, v, k):
        return f"arg_max({v}, {k})"

    def earliest(self, v, k):
        return f"arg_min({v}, {k})"

    def idiv(self, a, b):
        return f"({a} // {b})"

    def local(self, e):
        return f"strftime(timezone('{TZ}', to_timestamp({e})), '%Y-%m-%dT%H:%M:%S')"

    def local_date(self, e):
        return f"cast(timezone('{TZ}', to_timestamp({e})) AS date)"

    def local_hour(self, e):
        return f"cast(hour(timezone('{TZ}', to_timestamp({e}))) AS int)"

    def utc_of(self, day, hours):
        return f"cast(epoch(timezone('{TZ}', cast({day} AS timestamp) + INTERVAL {hours} HOUR)) AS bigint)"

    def last_day(self, month):
        return f"cast(day(last_day(cast({month} || '-01' AS date))) AS int)"

    def text(self, x):
        return f"cast({x} AS varchar)"

    def element(self, x, i):
        return f"cast({x}[{i}] AS double)"

    def array_of(self, x, key):
        return f"list({key} ORDER BY {key})"

    def pad2(self, x):
        return f"lpad(cast({x} AS varchar), 2, '0')"

    def same(self, a, b):
        return f"{a} IS NOT DISTINCT FROM {b}"


SPARK, DUCK = Spark(), Duck()
