"""SQL building blocks shared by the oracle texts: the views of ``sources.views`` and small macros."""

from __future__ import annotations

from riskspark.functions.numeric import POISSON_ONE_CDF
from riskspark.sources.views import BASELINE_END


def r(x: str, digits: int = 6) -> str:
    return f"floor(cast({x} as double) * 1e{digits} + 0.5) / 1e{digits}"


def hex_unit(digest: str, start: int = 1, digits: int = 8) -> str:
    return f"cast(cast('0x' || substr({digest}, {start}, {digits}) as bigint) as double) / {float(16**digits)!r}::double"


def md5_of(seed: str, key: str) -> str:
    return f"md5(concat_ws(':', '{seed}', cast({key} as varchar)))"


def u(seed: str, key: str, digits: int = 8) -> str:
    return hex_unit(md5_of(seed, key), 1, digits)


def poisson(x: str) -> str:
    return "(" + " + ".join(f"cast({x} >= {b!r}::double as integer)" for b in POISSON_ONE_CDF) + ")"


def div(a: str, b: str) -> str:
    return f"coalesce(cast({a} as double) / nullif(cast({b} as double), 0), 0)"


TX_EVENTS = """tx_events as (
  select event_id as TransactionID, ts as event_time,
         epoch_us(ts) // 1000000 - 1512000000 as TransactionDT,
         value as TransactionAmt, event_type as ProductCD, user_id as card1,
         cast(k as double) as C1, cast(100 + (user_id * 7) % 400 as double) as addr1,
         case when k % 10 <> 0 then cast(100 + (k * 13) % 400 as double) end as addr2,
         cast(k >= 90 as integer) as isFraud
  from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) e)"""

TX_ORDERS = """tx_orders as (
  select o_orderkey as TransactionID, o_orderdate as event_time, o_totalprice as TransactionAmt,
         o_orderpriority as ProductCD, o_custkey as card1,
         cast(100 + c_nationkey * 17 as double) as addr1,
         cast(o_orderstatus = 'F' as integer) as isFraud
  from orders left join customer on o_custkey = c_custkey)"""

IDENTITY = """identity as (
  select l_orderkey as TransactionID, min(l_quantity) as id_01, max(l_discount) as id_02, max(l_tax) as id_03
  from lineitem group by l_orderkey)"""

SCORES = f"""{TX_EVENTS},
scores as (
  select TransactionID, event_time, TransactionAmt, card1, ProductCD, isFraud as y,
         0.35::double * isFraud + 0.65::double * ({u('a', 'TransactionID')}) as pa,
         0.2::double * isFraud + 0.8::double * ({u('b', 'TransactionID')}) as pb
  from tx_events)"""

SIDES = f"""{SCORES},
baseline as (select TransactionID, event_time, pa as score, y from scores
             where event_time < timestamp '{BASELINE_END}'),
current_scores as (select TransactionID, event_time, least(1.0::double, pa + 0.15::double) as score, y from scores
                   where event_time >= timestamp '{BASELINE_END}')"""


def velocity_columns(hours: list[int], digits: int = 4, count: str = "count(TransactionAmt)") -> str:
    out = []
    for h in hours:
        for stat, expr in (("count", count), ("sum", "sum(TransactionAmt)"), ("std", "stddev_samp(TransactionAmt)")):
            value = f"coalesce(case when card1 is not null then {expr} over w{h} end, 0)"
            out.append(f"{value if stat == 'count' else r(value, digits)} as velocity_{stat}_{h}h")
    return ", ".join(out)


def velocity_windows(hours: list[int]) -> str:
    return "window " + ", ".join(
        f"w{h} as (partition by card1 order by event_time range between interval {h} hour preceding "
        "and interval 1 microsecond preceding)"
        for h in hours
    )
