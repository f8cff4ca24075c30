"""DuckDB twins of the fixture views, composed as CTEs for oracle SQL.

The text follows FIXTURES.md §2; ``with_views(body)`` prepends exactly the views
a query body mentions (and their dependencies), in dependency order.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def _view(name: str, sql: str, deps: list[str]):
    VIEWS[name] = sql.strip()
    DEPS[name] = deps


_view("fx_base", """
select event_id, ts, ts - interval 5 hours as ts_local, user_id, event_type, value,
       cast(regexp_extract(props, '[0-9]+', 0) as int) as k
from events""", [])

_view("fxd_base", """
select event_id, local + interval 5 hours as ts, local as ts_local, user_id, event_type, value, k
from (select *, timestamp '2024-01-02 09:30:00'
             + interval 1 day * cast(floor(event_id / 10000) as int)
             + interval 1 millisecond * cast((event_id % 10000) * 2340 + (user_id * 37) % 997 as int) as local
      from fx_base) b""", ["fx_base"])

_TRADES = """
select event_id as tr_seqnum, cast(ts_local as date) as trade_date, ts as ts_event_utc, ts_local as ts_event,
       concat('S', cast(user_id % 12 as varchar)) as sym_root,
       case user_id % 12 when 5 then 'A' when 7 then ' ' end as sym_suffix,
       case when user_id % 12 = 5 then 'S5.A' else concat('S', cast(user_id % 12 as varchar)) end as symbol,
       upper(substr(event_type, 1, 1)) as ex,
       100 + value / 500 as price, (k + 1) * 10 as size,
       case when event_id % 17 = 0 then '01' else '00' end as tr_corr, event_type as tr_scond
from {base} where event_id % 3 = 0"""

_NBBO = """
select event_id as qu_seqnum, cast(ts_local as date) as trade_date, ts as ts_event_utc, ts_local as ts_event,
       case when user_id % 12 = 5 then 'S5.A' else concat('S', cast(user_id % 12 as varchar)) end as symbol,
       100 + value / 500 - cast(k - 2 as double) / 200 as best_bid,
       100 + value / 500 + cast(k - 2 as double) / 200 as best_ask,
       cast((event_id % 50 + 1) * 100 as int) as best_bidsizeshares,
       cast((event_id % 70 + 1) * 100 as int) as best_asksizeshares,
       event_type as nbbo_qu_cond, substr(event_type, 1, 1) as qu_cond,
       case when event_id % 5 = 0 then 'G' else 'A' end as natbbo_ind,
       case when event_id % 2 = 0 then 'C' else 'N' end as qu_source
from {base} where event_id % 3 <> 0"""

_view("fx_trades", _TRADES.format(base="fx_base"), ["fx_base"])
_view("fx_nbbo", _NBBO.format(base="fx_base"), ["fx_base"])
_view("fxd_trades", _TRADES.format(base="fxd_base"), ["fxd_base"])
_view("fxd_nbbo", _NBBO.format(base="fxd_base"), ["fxd_base"])

_view("fx_quotes", """
select qu_seqnum, trade_date, ts_event_utc, ts_event, symbol, best_bid as bid, best_ask as ask,
       best_bidsizeshares as bidsiz, best_asksizeshares as asksiz, nbbo_qu_cond, qu_cond, natbbo_ind, qu_source,
       case when qu_seqnum % 29 = 0 then 'C' end as qu_cancel
from fx_nbbo""", ["fx_nbbo"])

_view("fx_catalog", """
select 'taq' as source, 'trades' as data_type, trade_date, symbol, count(*) as n_rows from fx_trades group by trade_date, symbol
union all
select 'taq', 'nbbo', trade_date, symbol, count(*) from fx_nbbo group by trade_date, symbol
union all
select 'alpaca', 'trades', trade_date, symbol, count(*) from fx_trades
where symbol <> 'S3' and tr_seqnum % 4 <> 0 group by trade_date, symbol
union all
select 'csv', 'nbbo', trade_date, symbol, count(*) from fx_nbbo
where trade_date < date '2024-01-11' group by trade_date, symbol""", ["fx_trades", "fx_nbbo"])

_view("fx_names", """
select o_custkey as permno, concat('T', cast(o_custkey % 400 as varchar)) as ticker,
       cast(min(o_orderdate) as date) as namedt, cast(max(o_orderdate) as date) as nameendt
from orders group by o_custkey""", [])

_view("fx_members", """
select c_custkey as permno, date '1995-06-01' as start,
       case when c_custkey % 4 = 0 then null else date '1999-12-31' end as ending
from customer where c_custkey % 3 = 0""", [])


def _needed(body: str) -> list[str]:
    out: list[str] = []

    def visit(v):
        for d in DEPS[v]:
            visit(d)
        if v not in out:
            out.append(v)

    for v in VIEWS:
        if re.search(rf"\b{v}\b", body):
            visit(v)
    return out


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it needs, then any ``extra`` CTEs."""
    ctes = [f"{v} as ({VIEWS[v]})" for v in _needed(body + " ".join((extra or {}).values()))]
    ctes += [f"{k} as ({v.strip()})" for k, v in (extra or {}).items()]
    body = body.strip()
    if not ctes:
        return body
    if body[:5].lower() == "with ":  # merge the body's own CTE list after ours
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body
