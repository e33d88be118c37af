"""What each query means in SQL that DuckDB runs on the same tables.

The suppression walk is written here with a window over the rows for each pass, where the engine works on the class table;
ranks, quantiles and intersections are written over rows too. Measures that a model learns have no SQL.
"""

from __future__ import annotations

from ..config import ATTACK_QI, CLASS_SETS, DESCRIPTIONS, KPIS, LABELLED, LINK_KEYS, METRICS, SENSITIVE, VOLUMES
from ..sources.tables import TELEMETRY

Q = {c: f'"{c}"' for c in (*TELEMETRY, "n")}
K = 3
QI = ["time_start", "province", "radio_access_type", "enb_id", "application_category"]


def _q(c: str) -> str:
    return f'"{c}"'


def _sig(x: str, s: int = 3) -> str:
    f = f"power(10e0, {s - 1} - floor(log10(abs({x}))))"
    return f"(case when {x} = 0 then 0e0 else round_even({x} * {f}, 0) / {f} end)"


def _cols(cs) -> str:  # noqa: ANN001
    return ", ".join(_q(c) for c in cs)


def _r(x: str, name: str, d: int = 6) -> str:
    return f"cast(round({x}, {d}) as double) as {name}"


def _n(x: str, name: str) -> str:
    return f"cast({x} as bigint) as {name}"


def _draw(*keys: str) -> str:
    return "md5(concat_ws(':', '0', " + ", ".join(f"cast({k} as varchar)" for k in keys) + "))"


EVENTS = "ev as (select *, cast(floor(epoch(ts)) as bigint) as sec, cast(floor(floor(epoch(ts)) / 3600) as bigint) % 24 as hod from events)"
RAW = EVENTS + ", raw as (select " + ", ".join(f'{e} as "{c}"' for c, e in TELEMETRY.items()) + " from ev)"
_TAC = "case when trim(imei) not in ('', 'nan') then substr(trim(imei), 1, 8) end"
GEN = (
    RAW
    + f", gen as (select row_id, msisdn as gt_user, row_id as gt_row_id, cast(floor(time_start / 3600) as bigint) as time_start, {_TAC} as imei, province, radio_access_type, enb_id, application_category, "
    + ", ".join(f"{_sig(_q(c))} as {_q(c)}" for c in KPIS)
    + " from raw)"
)


def _walk(k: int, keys: list[str], name: str = "anon") -> str:
    over = f"count(*) over (partition by {', '.join(keys)})"
    return (
        f", w0 as (select *, {over} as n0 from gen)"
        f", w1 as (select * exclude (application_category), case when n0 < {k} then 'RESTRICTED' else application_category end as application_category from w0)"
        f", w2 as (select *, {over} as n1 from w1)"
        f", w3 as (select * exclude (enb_id), case when n1 < {k} then 0 else enb_id end as enb_id from w2)"
        f", w4 as (select *, {over} as n2 from w3)"
        f", {name} as (select * exclude (n0, n1, n2) from w4 where n2 >= {k})"
    )


ANON = GEN + _walk(K, QI)
A = (
    ANON
    + ", a as (select *, coalesce(trim(imei), 'NA') as tac, cast(enb_id as varchar) as cell, enb_id = 0 as cell_gone, application_category = 'RESTRICTED' as app_gone, time_start % 24 as hod, (cast(floor(time_start / 24) as bigint) + 3) % 7 as dow from anon)"
)
AR = (
    A
    + ", rr as (select *, msisdn as gt_user, row_id as gt_row_id, substr(imei, 1, 8) as tac, cast(enb_id as varchar) as cell, cast(floor(time_start / 3600) as bigint) as hour from raw)"
    + ", r as (select *, hour % 24 as hod, (cast(floor(hour / 24) as bigint) + 3) % 7 as dow from rr)"
)
TIMED = RAW + ", timed as (select * replace (cast(floor(time_start / 3600) as bigint) as time_start), time_start as ts, cast(floor(time_start / 3600) as bigint) % 24 as hod from raw)"
_EXTRA = "(('0x' || substr(md5('0:' || cast(row_id as varchar)), 1, 4))::bigint % 21)"
UTIL = (
    ANON
    + f", orig as (select *, cast(cast(substr(imei, 1, 8) as bigint) + {_EXTRA} as varchar) as device_type from raw)"
    + f", rel as (select *, cast(cast(imei as bigint) + {_EXTRA} as varchar) as device_type from anon)"
)
RELEASED = ["time_start", "imei", "province", "radio_access_type", "enb_id", "application_category", *KPIS]


def _with(ctes: str, body: str) -> str:
    return f"with {ctes} {body}"


def _status(fail: str, warn: str) -> str:
    return f"case when {fail} then 'FAIL' when {warn} then 'WARN' else 'PASS' end"


def _risk(user: bool) -> str:
    base = ["time_start", "enb_id", "province", "radio_access_type"]
    sets = {"hour+cell": base[:2], "base": base, "base+app": [*base, "application_category"], "base+app+volumes": [*base, "application_category", *VOLUMES]}
    parts = []
    for name, keys in sets.items():
        if user:
            k = f"select cl.k from anon join (select {_cols(keys)}, count(distinct gt_user) as k from anon group by all) cl on " + " and ".join(f"anon.{_q(c)} is not distinct from cl.{_q(c)}" for c in keys)
        else:
            k = f"select count(*) over (partition by {_cols(keys)}) as k from anon"
        parts.append(
            f"select '{name}' as keys, {_n('min(k)', 'min_k')}, {_r('median(k)', 'median_k')}, {_r('avg((k = 1)::int)', 'share_k1')}, {_r(f'avg((k < {K})::int)', 'share_below_k')}, "
            f"{_r('1 / min(k)', 'prosecutor_max_risk')}, {_r('avg(1e0 / k)', 'marketer_avg_risk')}, {_status('avg((k = 1)::int) > 0', f'avg((k < {K})::int) > 0.01')} as status from ({k})"
        )
    return _with(ANON, " union all ".join(parts))


def _uniqueness() -> str:
    sets = {"QI": [*ATTACK_QI], "QI+TAC": [*ATTACK_QI, "tac"], "KPI": [*KPIS], "TAC+KPI": ["tac", *KPIS], "QI+TAC+KPI": [*ATTACK_QI, "tac", *KPIS]}
    parts = []
    for name, keys in sets.items():
        single = _r("sum(case when u = 1 then n else 0 end) / sum(n)", "rows_single_user") if name in ("QI", "QI+TAC") else "cast(null as double) as rows_single_user"
        parts.append(f"select '{name}' as keys, {_r('sum(case when n = 1 then n else 0 end) / sum(n)', 'rows_unique')}, {single} from (select count(*) as n, count(distinct gt_user) as u from a group by {_cols(keys)})")
    return _with(A, " union all ".join(parts))


def _equivalence() -> str:
    parts = []
    for s in CLASS_SETS:
        over = f"select count(*) over (partition by {_cols(s)}) as n from anon"
        classes = f"(select count(*) from (select 1 from anon group by {_cols(s)}))"
        parts.append(f"select '{'+'.join(s)}' as qi_set, {_n(classes, 'classes')}, {_n('min(n)', 'min_k')}, {_r('avg((n = 1)::int)', 'share_k1')}, {_r(f'avg((n < {K})::int)', 'share_below_k')}, {_r('median(n)', 'median_k')}, {_n(f'sum((n < {K})::int)', 'violating_rows')} from ({over})")
    return _with(ANON, " union all ".join(parts))


def _violating() -> str:
    parts = [f"select row_id, '{'+'.join(s)}' as qi_set, n as class_size from (select row_id, count(*) over (partition by {_cols(s)}) as n from anon) where n < {K}" for s in CLASS_SETS]
    return _with(ANON, " union all ".join(parts))


LABELS = (
    ANON
    + ", cells as (select time_start, enb_id, province, radio_access_type, application_category as l, count(*) as n from anon where application_category is not null group by all)"
    + ", gl as (select l, sum(n) / (select sum(n) from cells) as pg from cells group by l)"
    + ", classes as (select time_start, enb_id, province, radio_access_type, sum(n) as size from cells group by all)"
    + ", dist as (select c.*, coalesce(x.n, 0) / c.size as p, g.pg from classes c cross join gl g left join cells x on x.l = g.l and x.time_start = c.time_start and x.enb_id = c.enb_id and x.province is not distinct from c.province and x.radio_access_type = c.radio_access_type)"
    + ", lab as (select time_start, enb_id, province, radio_access_type, cast(any_value(size) as bigint) as n, max(p) as top, 0.5 * sum(abs(p - pg)) as tvd from dist group by all)"
)


def _t_closeness() -> str:
    h, f = (f"coalesce(sum(case when {c} then n else 0 end) / greatest(sum(n), 1), 0)" for c in ("round(top, 9) > 0.9", "round(tvd, 9) > 0.3"))
    lab = f"(select count(*) from gl where regexp_matches(l, '{SENSITIVE}', 'i'))"
    rare = "(select count(*) from gl where pg < 0.01)"
    return _with(
        LABELS,
        f"select {_n('count(*)', 'classes')}, {_n('coalesce(sum(n), 0)', 'rows')}, {_r(h, 'homogeneous_share')}, {_r(f, 'far_share')}, {_n(lab, 'sensitive_labels')}, {_n(rare, 'rare_labels')}, "
        f"{_status(f'{h} > 0.20', f'{h} > 0.05 or {f} > 0.20 or {lab} > 0')} as status from lab where n >= {K}",
    )


def _inference() -> str:
    keys = ["time_start", "enb_id", "province", "radio_access_type"]
    on = lambda x, y: " and ".join(f"{x}.{c} = {y}.{c}" for c in keys)
    ctes = (
        ANON
        + ", t as (select *, substr(md5('0:' || gt_user), 1, 4) < 'b333' as inside, application_category as label from anon)"
        + f", counts as (select {_cols(keys)}, label, count(*) as n from t where inside and label is not null and province is not null group by all)"
        + f", best as (select {_cols(keys)}, label as guess from counts qualify row_number() over (partition by {_cols(keys)} order by n desc, label) = 1)"
        + ", mode as (select label from t where inside and label is not null group by label order by count(*) desc, label limit 1)"
        + "".join(
            f", s{m} as (select * from t where {w} and label is not null order by {_draw('gt_row_id')}, gt_row_id limit 1000), h{m} as (select avg((coalesce(b.guess, (select label from mode)) = s.label)::int) as p, count(*) as n from s{m} s left join best b on {on('s', 'b')})"
            for m, w in (("m", "inside"), ("c", "not inside"))
        )
        + ", o as (select hm.p as pm, hm.n as nm, hc.p as pc, hc.n as nc, case when hc.p < 1 then greatest(0, (hm.p - hc.p) / (1 - hc.p)) else 0 end as risk, (select sum(inside::int) from t) as rm, (select sum((not inside)::int) from t) as rc from hm, hc)"
    )
    margin = lambda p, n: f"1.96 * sqrt({p} * (1 - {p}) / {n})"
    return _with(
        ctes,
        f"select {_r('pm', 'members_accuracy')}, {_r(margin('pm', 'nm'), 'members_margin')}, {_r('pc', 'control_accuracy')}, {_r(margin('pc', 'nc'), 'control_margin')}, {_r('risk', 'risk')}, nm as members, nc as control, "
        f"case when rm < 100 or rc < 100 then 'SKIP' else {_status('risk >= 0.2', 'risk >= 0.05')} end as status from o",
    )


def _unicity_parts(points: str, sizes: tuple[int, ...], samples: int, prefix: str = "") -> list[str]:
    """One SELECT for each p over a CTE (entity, h, c) of distinct points."""
    out = []
    for p in sizes:
        elig = f"(select entity from {points} group by entity having count(*) >= {p})"
        some = f"(select entity from {elig} order by {_draw('entity')}, entity limit {samples})"
        chosen = f"(select * from (select x.*, row_number() over (partition by entity order by {_draw('entity', 'h', 'c')}, h, c) as k from {points} x where entity in {some}) where k <= {p})"
        held = f"(select ch.entity as t, i.entity as cand from {chosen} ch join {points} i on ch.h = i.h and ch.c = i.c group by all having count(*) = {p})"
        out.append(f"select {prefix}cast({p} as bigint) as p, (select count(*) from {elig}) as eligible, count(*) as sampled, avg((n = 1)::int) as unicity from (select t, count(*) as n from {held} group by t)")
    return out


def _unicity() -> str:
    points = TIMED + ", pts as (select distinct msisdn as entity, time_start as h, enb_id as c from timed where msisdn is not null and time_start is not null and enb_id is not null)"
    return _with(points, f"select p, eligible, sampled, case when eligible >= 20 then {_r('unicity', 'u').rsplit(' as ', 1)[0]} end as unicity from (" + " union all ".join(_unicity_parts("pts", (2, 3, 4), 500)) + ")")


HOME = (
    TIMED
    + ", nc as (select msisdn, enb_id, count(*) as n from timed where hod >= 22 or hod < 6 group by all)"
    + ", home as (select msisdn, enb_id from nc qualify row_number() over (partition by msisdn order by n desc, enb_id) = 1)"
    + ", res as (select *, count(*) over (partition by enb_id) as k from home)"
)


def _home_exposure(k: int = 5) -> str:
    s = f"avg((k < {k})::int)"
    return _with(HOME, f"select count(*) as users, {_r(s, 'exposed_share')}, case when (select count(distinct hod) from timed) <= 1 or count(*) = 0 then 'SKIP' else {_status(f'{s} > 0.05', f'{s} > 0.01')} end as status from res")


def _relink_ctes() -> str:
    cs = [*METRICS, *VOLUMES]
    sd = ", ".join(f"avg({_q(c)}) as {_q('m_' + c)}, stddev_pop({_q(c)}) as {_q('s_' + c)}" for c in cs)
    z = ", ".join(f"({_q(c)} - {_q('m_' + c)}) / (case when {_q('s_' + c)} = 0 then 1 else {_q('s_' + c)} end) as {_q(c)}" for c in cs)
    d = " + ".join(f"power(x.{_q(c)} - y.{_q(c)}, 2)" for c in cs)
    return (
        TIMED
        + ", cut as (select ts as cut from timed where ts is not null order by ts limit 1 offset (select count(*) // 2 from timed where ts is not null))"
        + ", hv as (select timed.*, ts >= cut as late from timed, cut)"
        + ", mu as (select msisdn, late, " + ", ".join(f"avg({_q(c)}) as {_q(c)}" for c in cs) + " from hv group by all)"
        + ", ok as (select * from mu where " + " and ".join(f"{_q(c)} is not null" for c in cs) + ")"
        + f", chosen as (select msisdn from ok group by msisdn having count(*) = 2 order by {_draw('msisdn')}, msisdn limit 2000)"
        + ", lg as (select msisdn, late, " + ", ".join(f"ln(1 + greatest({_q(c)}, 0)) as {_q(c)}" for c in cs) + " from ok where msisdn in (select msisdn from chosen))"
        + f", sp as (select {sd} from lg), zz as (select msisdn, late, {z} from lg, sp)"
        + ", mc as (select msisdn, late, enb_id from (select msisdn, late, enb_id, count(*) as n from hv group by all) qualify row_number() over (partition by msisdn, late order by n desc, enb_id) = 1)"
        + f", pr as (select x.msisdn as a, y.msisdn as b, round({d}, 9) as d, hx.enb_id is distinct from hy.enb_id as moved from zz x join zz y on not x.late and y.late left join mc hx on hx.msisdn = x.msisdn and not hx.late left join mc hy on hy.msisdn = y.msisdn and hy.late)"
        + ", vv as (select 'metrics' as variant, a, b, d from pr union all select 'metrics+home', a, b, d + case when moved then 1000 else 0 end from pr)"
        + ", rk as (select *, row_number() over (partition by variant, a order by d, b) as k from vv)"
        + ", relinked as (select variant, count(*) as subscribers, avg((k = 1)::int) as top1, avg((k <= 5)::int) as top5 from rk where a = b group by variant)"
    )


def _precision_ctes(source: str) -> str:
    cs = [*VOLUMES, *METRICS]
    long = " union all ".join(f"select '{c}' as col, {_q(c)} as v from {source} where {_q(c)} is not null" for c in cs)
    dec = "case " + " ".join(f"when max(abs(round_even(v * 1e{d}, 0) / 1e{d} - v)) <= 1e-9 then {d}" for d in range(10)) + " else 10 end"
    return (
        f", lv as ({long}), once as (select col, count(*) as k from (select col, v from lv group by all having count(*) = 1) group by col)"
        f", pt as (select col, count(*) as n, {dec} as decimals, quantile_cont(v, 0.5) as p50, quantile_cont(v, 0.999) as p999, max(v) as mx from lv group by col)"
        ", pv as (select pt.*, coalesce(once.k, 0) / pt.n as u, coalesce(p999 > 0 and mx / p999 > 10, false) as outlier, col in (" + ", ".join(f"'{c}'" for c in VOLUMES) + ") as vol from pt left join once using (col))"
        f", ps as (select *, {_status('vol and u > 0.5', '(vol and (decimals > 3 or u > 0.2 or outlier)) or (not vol and decimals > 3 and u > 0.5)')} as status from pv)"
    )


def _precision(ctes: str, source: str) -> str:
    return _with(ctes + _precision_ctes(source), f'select col as "column", n, {_r("u", "unique_value_share")}, {_n("decimals", "decimals")}, {_r("p50", "p50")}, {_r("p999", "p99_9")}, {_r("mx", "max")}, outlier, status from ps')


_LUHN = "(list_sum(list_transform(range(0, 15), lambda i: (case when i % 2 = 1 then (case when 2 * cast(substr(v, 15 - i, 1) as int) > 9 then 2 * cast(substr(v, 15 - i, 1) as int) - 9 else 2 * cast(substr(v, 15 - i, 1) as int) end) else cast(substr(v, 15 - i, 1) as int) end))) % 10 = 0)"
_IDS = ["msisdn", "imsi", "imei", "province", "radio_access_type", "enb_id", "application_category"]


def _scan_ctes(source: str) -> str:
    long = " union all ".join(f"select '{c}' as col, trim(cast({c} as varchar)) as v from {source} where {c} is not null" for c in _IDS)
    fifteen = "regexp_full_match(v, '[0-9]{15}')"
    return (
        f", iv as ({long}), sh as (select col, avg((case when {fifteen} then {_LUHN} else false end)::int) as imei_like, avg(regexp_full_match(v, '\\+?[1-9][0-9]{{7,14}}')::int) as e164_like, avg({fifteen}::int) as imsi_like from iv group by col)"
        ", scan as (select col, 'imei_like' as pattern, imei_like as share from sh union all select col, 'e164_like', e164_like from sh union all select col, 'imsi_like', imsi_like from sh)"
    )


def _shape(column: str, expr: str) -> str:
    probe = f"(select v from (select distinct trim({expr}) as v from raw where {expr} is not null) order by md5('0:' || v), v limit 5000)"
    hexes = "avg((regexp_full_match(v, '[0-9a-fA-F]+') and length(v) in (32, 40, 64, 128))::int)"
    digits = "avg(regexp_full_match(v, '\\+?[0-9]{8,15}')::int)"
    return (
        f"select '{column}' as \"column\", (select count(distinct trim({expr})) from raw) as distinct_values, {_r(digits, 'digit_share')}, {_r(hexes, 'hex_share')}, "
        f"case when {hexes} > 0.9 then case min(length(v)) when 32 then 'md5' when 40 then 'sha1' when 64 then 'sha256' when 128 then 'sha512' end end as algorithm, "
        f"case when count(*) = 0 then 'SKIP' when {digits} > 0.9 then 'FAIL' when {hexes} <= 0.9 then 'PASS' else 'WARN' end as status from {probe}"
    )


def _enumeration(limit: int = 100_000) -> str:
    ctes = (
        RAW
        + ", tg as (select v from (select distinct sha256(msisdn) as v from raw) order by md5('0:' || v), v limit 200)"
        + f", cand as (select unnest(['+35840' || lpad(cast(i as varchar), 7, '0'), '35840' || lpad(cast(i as varchar), 7, '0')]) as c from range({limit}) t(i))"
        + ", hit as (select count(distinct sha256(c)) as n from cand where sha256(c) in (select v from tg))"
    )
    return _with(ctes, f"select (select count(*) from tg) as targets, n as recovered, cast({2 * limit} as bigint) as candidates, {_r(f'{limit} / 1e7', 'space_covered')}, case when n > 0 then 'FAIL' else 'WARN' end as status from hit")


def _home_work() -> str:
    mode = lambda src, key, where, name: f"(select {key}, cell as {name} from (select {key}, cell, count(*) as n from {src} where {where} group by all) qualify row_number() over (partition by {key} order by n desc, cell) = 1)"
    night, work = "hod between 0 and 5", "dow < 5 and hod between 9 and 16"
    ctes = (
        AR
        + f", guess as (select 'home' as label, * from {mode('a', 'tac', 'not cell_gone and ' + night, 'g')} union all select 'work', * from {mode('a', 'tac', 'not cell_gone and ' + work, 'g')})"
        + f", anc as (select 'home' as label, * from {mode('r', 'gt_user', night, 'c')} union all select 'work', * from {mode('r', 'gt_user', work, 'c')})"
        + ", mem as (select distinct tac, gt_user from a where tac <> 'NA'), cnt as (select tac, count(*) as users from mem group by tac having count(*) <= 10)"
        + ", tr as (select label, mem.tac, users, c from mem join cnt using (tac) join anc using (gt_user))"
        + ", ev2 as (select g.label, g.tac, any_value(users) as users, count(distinct c) as places, max((c = g.g)::int) as hit from guess g join tr on tr.label = g.label and tr.tac = g.tac group by all)"
        + ", nc as (select greatest(count(distinct cell), 1) as cells from a where not cell_gone)"
    )
    tier = "case when users = 1 then '1-1' when users <= 3 then '2-3' else '4-10' end"
    return _with(ctes, f"select label, {tier} as tier, count(*) as tacs_evaluated, {_r('avg(hit)', 'accuracy')}, {_r('avg(places / cells)', 'random_baseline')}, {_n('sum((users = 1 and hit = 1)::int)', 'single_user_located')} from ev2, nc group by label, tier")


def _points_parts(sizes: tuple[int, ...]) -> list[str]:
    out = []
    for p in sizes:
        some = f"(select entity from pts group by entity having count(*) >= {p} order by {_draw('entity')}, entity limit 300)"
        chosen = f"(select * from (select x.*, row_number() over (partition by entity order by {_draw('entity', 'hour', 'cell', 'tac')}, hour, cell, tac) as k from pts x where entity in {some}) where k <= {p})"
        for known, keys in (("points_only", ["hour", "cell"]), ("points_plus_tac", ["hour", "cell", "tac"])):
            idx = f"(select distinct gt_user as cand, time_start as hour, cell{', tac' if 'tac' in keys else ''} from a where not cell_gone)"
            held = f"(select ch.entity as t, i.cand from {chosen} ch join {idx} i on " + " and ".join(f"ch.{c} = i.{c}" for c in keys) + f" group by all having count(*) = {p})"
            each = f"(select s.entity, count(h.cand) as n, coalesce(max((h.cand = s.entity)::int), 0) as hit from {some} s left join {held} h on h.t = s.entity group by s.entity)"
            out.append(f"select cast({p} as bigint) as points, '{known}' as known, count(*) as targets, {_r('avg(hit)', 'target_in_candidates')}, {_r('avg((hit = 1 and n = 1)::int)', 'uniquely_identified')}, {_r('median(n)', 'median_candidates')} from {each}")
    return out


POINTS = AR + ", pts as (select distinct gt_user as entity, hour, cell, tac from r)"


def _runs_ctes() -> str:
    out = ANON
    for i, keys in enumerate(LINK_KEYS):
        ks = _cols(keys)
        some_null = " or ".join(f"{_q(c)} is null" for c in keys)
        out += f", c{i} as (select {ks}, time_start as hour, count(*) as n, min(enb_id) as cell0 from anon group by {ks}, time_start)"
        out += f", u{i} as (select *, sum(st) over (partition by {ks} order by hour) as run from (select *, case when not ({some_null}) and hour - lag(hour) over (partition by {ks} order by hour) = 1 then 0 else 1 end as st from c{i} where n = 1))"
        out += f", l{i} as (select count(*) as length, any_value(hour) as h from u{i} group by {ks}, run)"
    return out


def _name(keys: tuple[str, ...]) -> str:
    return "+".join(keys)


def _over_keys(part) -> str:  # noqa: ANN001
    return _with(_runs_ctes(), " union all ".join(f"select * from ({part(i, k)})" for i, k in enumerate(LINK_KEYS)))


def _next_hour(i: int, keys: tuple[str, ...]) -> str:
    on = " and ".join(f"x.{_q(c)} is not distinct from y.{_q(c)}" for c in keys)
    total = "(select count(*) from anon)"
    return (
        f"select '{_name(keys)}' as link_key, {_r(f'(select count(*) from c{i} where n = 1) / {total}', 'share_rows_unambiguous')}, {_r('avg((y.n is not null)::int)', 'share_hours_with_next')}, "
        f"{_r('avg(coalesce(x.n = 1 and y.n = 1, false)::int)', 'share_hours_one_to_one')}, {_r('median(y.n)', 'median_next')}, (select count(*) from l{i}) as chains, "
        f"{_n(f'(select count(*) from l{i} where length = 1)', 'chains_len_1')}, {_n(f'(select count(*) from l{i} where length >= 2)', 'chains_len_ge_2')}, "
        f"{_r(f'(select coalesce(sum(length), 0) from l{i} where length >= 2) / {total}', 'rows_in_long_chains')}, (select coalesce(max(length), 0) from l{i}) as chain_len_max, "
        f"{_r(f'(select quantile_cont(length, 0.5) from l{i})', 'chain_len_p50')}, {_r(f'(select quantile_cont(length, 0.9) from l{i})', 'chain_len_p90')} from c{i} x left join c{i} y on {on} and y.hour = x.hour + 1"
    )


def _chain_unicity() -> str:
    ctes, parts = _runs_ctes(), []
    for i, keys in enumerate(LINK_KEYS):
        text = "concat_ws('|', " + ", ".join(f"coalesce('=' || cast({_q(c)} as varchar), '-')" for c in keys) + ")"
        ctes += f", p{i} as (select concat_ws('#', {text}, cast(run as varchar)) as entity, hour as h, cell0 as c from u{i} where cell0 is not null)"
        parts += _unicity_parts(f"p{i}", (1, 2, 3, 4), 500, f"'{_name(keys)}' as link_key, ")
    return _with(ctes, f"select link_key, p, eligible, sampled, {_r('unicity', 'unicity')} from (" + " union all ".join(parts) + ")")


def _footprint() -> str:
    flag = "(app_gone or cell_gone)::int"
    one = lambda m, v: f"select '{m}' as metric, '' as scope, {_r(v, 'value')}"
    hod = f"(select hod, avg({flag}) as rate from a group by hod)"
    drop = "(select r.hod, avg((x.gt_row_id is null)::int) as rate from r left join a x on x.gt_row_id = r.gt_row_id group by r.hod)"
    parts = [
        one("share_app_restricted", "(select avg(app_gone::int) from a)"),
        one("share_cell_zero", "(select avg(cell_gone::int) from a)"),
        one("flag_rate_by_hour_min", f"(select min(rate) from {hod})"),
        one("flag_rate_by_hour_max", f"(select max(rate) from {hod})"),
        f"select 'flag_rate_top_province' as metric, province as scope, value from (select province, {_r(f'avg({flag})', 'value')} from a where province is not null group by province order by value desc, province limit 3)",
        one("rows_dropped_share", "1 - (select count(*) from a) / (select count(*) from r)"),
        one("users_with_all_rows_dropped", "(select count(distinct gt_user) from r where gt_user not in (select gt_user from a))"),
        one("hour_province_cells_with_missing_rows", "(select avg(missing::int) from hp)"),
        one("drop_rate_by_hour_min", f"(select min(rate) from {drop})"),
        one("drop_rate_by_hour_max", f"(select max(rate) from {drop})"),
    ]
    return _with(AR + HP, " union all ".join(f"select * from ({p})" for p in parts))


HP = (
    ", hp as (select coalesce(x.hour, y.hour) as hour, coalesce(x.province, y.province) as province, coalesce(x.n, 0) as raw, coalesce(y.n, 0) as anon, coalesce(y.n, 0) < coalesce(x.n, 0) as missing"
    " from (select hour, province, count(*) as n from r where province is not null group by all) x full join (select time_start as hour, province, count(*) as n from a where province is not null group by all) y on x.hour = y.hour and x.province = y.province)"
)


def _cell_recovery() -> str:
    ctes = (
        AR
        + f", gone as (select gt_row_id, tac, province, time_start from a where cell_gone order by {_draw('gt_row_id')}, gt_row_id limit 5000)"
        + ", tried as (select g.*, r.cell as true_cell from gone g join r on r.gt_row_id = g.gt_row_id)"
        + ", known as (select * from a where not cell_gone and province is not null)"
        + ", votes as (select t.gt_row_id, k.cell, count(*) as n from tried t join known k on k.tac = t.tac and k.province = t.province and abs(k.time_start - t.time_start) <= 2 group by all)"
        + ", best as (select gt_row_id, cell from votes qualify row_number() over (partition by gt_row_id order by n desc, cell) = 1)"
        + ", pm as (select province, cell from (select province, cell, count(*) as n from known group by all) qualify row_number() over (partition by province order by n desc, cell) = 1)"
        + ", m as (select t.*, b.cell as guess, pm.cell as common from tried t left join best b using (gt_row_id) left join pm on pm.province = t.province)"
    )
    return _with(
        ctes,
        f"select (select count(*) from a where cell_gone) as suppressed_rows, count(*) as rows_tried, {_r('count(guess) / nullif(count(*), 0)', 'coverage')}, {_r('sum((guess = true_cell)::int) / nullif(count(guess), 0)', 'accuracy')}, {_r('sum(coalesce(common = true_cell, false)::int) / nullif(count(*), 0)', 'province_baseline')} from m",
    )


def _linking_ctes() -> str:
    cs = [*METRICS]
    lg = ", ".join(f"case when {_q(c)} is not null then ln(1 + greatest({_q(c)}, 0)) end as {_q(c)}" for c in cs)
    fl = ", ".join(f"coalesce({_q(c)}, (select median({_q(c)}) from lg)) as {_q(c)}" for c in cs)
    z = ", ".join(f"coalesce(({_q(c)} - (select avg({_q(c)}) from fl)) / (select case when stddev_samp({_q(c)}) = 0 then 1 else stddev_samp({_q(c)}) end from fl), 0) as {_q(c)}" for c in cs)
    d = " + ".join(f"power(x.{_q(c)} - y.{_q(c)}, 2)" for c in cs)
    return (
        f", lg as (select row_id, gt_user, tac, province, time_start as h, {lg} from a), fl as (select row_id, gt_user, tac, province, h, {fl} from lg)"
        f", zz as (select row_id, gt_user, tac, province, h, {z} from fl where province is not null and tac <> 'NA' and tac in (select tac from a group by tac having count(distinct gt_user) <= 50))"
        ", sz as (select tac, province, h, count(*) as n from zz group by all)"
        ", bl as (select x.tac, x.province, x.h, y.n as nxt, x.n * y.n > 4000000 as skip from sz x join sz y on y.tac = x.tac and y.province = x.province and y.h = x.h + 1)"
        f", pr as (select x.row_id, x.gt_user, y.gt_user as u2, row_number() over (partition by x.row_id order by round({d}, 9), y.row_id) as k, sum((y.gt_user = x.gt_user)::int) over (partition by x.row_id) as own, b.nxt from zz x join bl b on b.tac = x.tac and b.province = x.province and b.h = x.h and not b.skip join zz y on y.tac = x.tac and y.province = x.province and y.h = x.h + 1)"
        ", lk as (select count(*) as n, sum((u2 = gt_user)::int) as hits, sum(own / nxt) as chance from pr where k = 1 and own > 0)"
    )


_LK = f"n as rows_evaluated, {_r('hits / nullif(n, 0)', 'link_accuracy')}, {_r('chance / nullif(n, 0)', 'chance_baseline')}, {_r('(hits / nullif(n, 0)) / greatest(chance / nullif(n, 0), 1e-12)', 'lift')}, cast(coalesce((select sum(skip::int) from bl), 0) as bigint) as skipped_blocks from lk"
ORDER = ", o as (select row_id, gt_user = lag(gt_user) over (order by row_id) as same, time_start >= lag(time_start) over (order by row_id) as rising, lag(row_id) over (order by row_id) as p from a), ad as (select avg(same::int) as adj, avg(rising::int) as srt from o where p is not null), ex as (select sum(n * n) / power(sum(n), 2) as e from (select count(*) as n from a group by gt_user))"


def _profile_base() -> str:
    kinds = {c: "identifier_like" if c == "imei" else "enb" if c == "enb_id" else "allowlisted_categorical" if c in LABELLED else "numeric" for c in RELEASED}
    parts = []
    for c in ["row_id", *RELEASED]:
        said = f"'{DESCRIPTIONS[c]}'" if c in DESCRIPTIONS else "cast(null as varchar)"
        q = _q(c)
        parts.append(f"select '{c}' as name, '{kinds.get(c, 'numeric')}' as kind, {said} as description, count(*) as count, count(*) - count({q}) as missing, {_r(f'(count(*) - count({q})) / count(*)', 'missing_share')}, count(distinct {q}) as n_unique from anon")
    return _with(ANON, " union all ".join(parts))


def _profile_categories() -> str:
    parts = []
    for c in ("province", "radio_access_type", "application_category"):
        counts = f"(select {c} as label, count(*) as n from anon where {c} is not null group by {c})"
        parts.append(f"select '{c}' as \"column\", label, n as count from {counts} where n >= {K}")
        parts.append(f"select '{c}' as \"column\", 'OTHER' as label, cast(sum(n) as bigint) as count from {counts} where n < {K} having sum(n) >= {K}")
    return _with(ANON, " union all ".join(parts))


def _profile_numeric(ctes: str, source: str, columns) -> str:  # noqa: ANN001
    parts = []
    for c in columns:
        x = f"cast({_q(c)} as double)"
        qs = ", ".join(f"{_sig(f'quantile_cont({x}, {p})')} as {n}" for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.99, "p99")))
        parts.append(f"select '{c}' as \"column\", {qs}, {_sig(f'min({x})')} as min_rounded, {_sig(f'max({x})')} as max_rounded from {source} having count({_q(c)}) > 0")
    body = " union all ".join(parts)
    return _with(ctes, body) if ctes else body


def _utility_parts() -> dict[str, str]:
    ok = lambda c: f"case when {c} then 'PASS' else 'FAIL' end as status"
    out = {"M1": f"select 'row_retention' as item, {_r('a / o', 'value')}, {ok('a / o >= 0.95')} from (select (select count(*) from rel) as a, (select count(*) from orig) as o)"}
    parts = []
    for c in KPIS:
        share = lambda t: f"(select avg(({_q(c)} is not null)::int) from {t})"  # noqa: B023, E731
        v = f"{share('rel')} / {share('orig')}"
        parts.append(f"select '{c}' as item, {_r(v, 'value')}, {ok(f'round({v}, 9) >= 0.95')} where {share('orig')} > 0")
    out["M3"] = " union all ".join(parts)
    parts = []
    for c in KPIS:
        q = _q(c)
        vals = f"(select v, sum(o) as no, sum(1 - o) as na from (select {q} as v, 1 as o from orig where {q} is not null union all select {q}, 0 from rel where {q} is not null) group by v)"
        ks = f"(select max(abs(fo - fa)) from (select sum(no) over (order by v) / sum(no) over () as fo, sum(na) over (order by v) / sum(na) over () as fa from {vals}))"
        err = lambda p: f"(select case when o = 0 and a = 0 then 0 else abs(a - o) / greatest(abs(o), 1e-12) end from (select (select quantile_cont({q}, {p}) from orig) as o, (select quantile_cont({q}, {p}) from rel) as a))"  # noqa: B023, E731
        parts.append(f"select '{c}' as item, {ks} as ks, {err(0.5)} as e50, {err(0.95)} as e95")
    ks_all = " union all ".join(parts)
    out["M4"] = f"select item, {_r('ks', 'ks')}, {_r('e50', 'median_error')}, {_r('e95', 'p95_error')}, {ok('round(ks, 9) <= 0.05 and round(e50, 9) <= 0.05 and round(e95, 9) <= 0.05')} from ({ks_all})"
    parts = []
    for c in ("radio_access_type", "province", "application_category", "device_type"):
        sh = lambda t: f"(select coalesce(cast({c} as varchar), 'nan') as l, count(*) / (select count(*) from {t}) as p from {t} group by 1)"  # noqa: B023, E731
        v = f"(select sum(0.5 * (case when p > 0 then p * log2(2 * p / (p + q)) else 0 end) + 0.5 * (case when q > 0 then q * log2(2 * q / (p + q)) else 0 end)) from (select coalesce(x.p, 0) as p, coalesce(y.p, 0) as q from {sh('orig')} x full join {sh('rel')} y on x.l = y.l))"
        parts.append(f"select '{c}' as item, {v} as v")
    out["M5"] = f"select item, {_r('v', 'value')}, {ok('round(v, 9) <= 0.02')} from ({' union all '.join(parts)})"
    return out


def _spearman(source: str, name: str) -> str:
    long = " union all ".join(f"select row_id, {i} as c, {_q(c)} as v from {source} where {_q(c)} is not null" for i, c in enumerate(KPIS))
    return (
        f", l_{name} as ({long})"
        f", p_{name} as (select x.c as ca, y.c as cb, x.v as va, y.v as vb from l_{name} x join l_{name} y on x.row_id = y.row_id and x.c < y.c)"
        f", k_{name} as (select ca, cb, rank() over (partition by ca, cb order by va) + (count(*) over (partition by ca, cb, va) - 1) / 2 as ra, rank() over (partition by ca, cb order by vb) + (count(*) over (partition by ca, cb, vb) - 1) / 2 as rb from p_{name})"
        f", s_{name} as (select ca, cb, corr(ra, rb) as rho from k_{name} group by all)"
    )


RHO = UTIL + _spearman("orig", "o") + _spearman("rel", "a")
_NAMES = "list_value(" + ", ".join(f"'{c}'" for c in KPIS) + ")"


def _findings_ctes() -> str:
    med = lambda t, k: f"(select {k} as k, median(tp_dl_avg) as m, count(tp_dl_avg) as n from {t} where {k} is not null group by {k})"
    return (
        f", rt as (select x.k, x.m as o, y.m as a from {med('orig', 'radio_access_type')} x join {med('rel', 'radio_access_type')} y using (k))"
        ", hi as (select * from rt order by o desc, k desc limit 1), lo as (select * from rt order by o, k limit 1)"
        ", gp as (select hi.o - lo.o as o, hi.a - lo.a as a from hi, lo)"
        ", ge as (select case when o = 0 and a = 0 then 0 else abs(a - o) / greatest(abs(o), 1e-12) end as e from gp)"
        f", pv as (select x.k, x.m as o, y.m as a from {med('orig', 'province')} x join {med('rel', 'province')} y using (k) where x.n >= 30 and y.n >= 30)"
        ", pk as (select rank() over (order by o) + (count(*) over (partition by o) - 1) / 2 as ro, rank() over (order by a) + (count(*) over (partition by a) - 1) / 2 as ra from pv)"
        ", ph as (select case when count(*) >= 3 then case when isnan(corr(ro, ra)) then null else corr(ro, ra) end end as rho from pk)"
    )


def _findings() -> str:
    return (
        f"select 'rat_gap_rel_err' as item, {_r('e', 'value')}, case when round(e, 9) <= 0.05 then 'PASS' else 'FAIL' end as status from ge union all "
        f"select 'province_ranking_spearman' as item, {_r('rho', 'value')}, case when rho is null or round(rho, 9) >= 0.95 then 'PASS' else 'FAIL' end as status from ph"
    )


def _worst_cells() -> str:
    cells = lambda t: f"(select distinct cast(enb_id as varchar) as cell from {t} where enb_id is not null and cast(enb_id as varchar) <> '0')"
    common = f"(select count(*) from {cells('orig')} join {cells('rel')} using (cell))"
    in_anon = f"greatest((select count(*) from {cells('rel')}), 1)"
    parts = []
    for s in ("tcp_retrans_byte_ratio_downlink_avg", "cont_rtt_radio_avg"):
        mean = lambda t: f"(select cast(enb_id as varchar) as cell, round(avg({s}), 9) as m, count({s}) as n from {t} where cast(enb_id as varchar) <> '0' group by 1)"  # noqa: B023, E731
        both = f"(select cell, x.m as o, y.m as a from {mean('orig')} x join {mean('rel')} y using (cell) where x.n >= 20 and y.n >= 20)"
        rk = f"(select row_number() over (order by o desc, cell) as ro, row_number() over (order by a desc, cell) as ra, greatest(floor(count(*) over () * 0.05), 1) as k from {both})"
        v = f"(select avg((ra <= k)::int) from {rk} where ro <= k)"
        skip = f"({common} < 20 or {common} < 0.01 * {in_anon})"
        parts.append(f"select 'recall {s}' as item, case when not {skip} then cast(round({v}, 6) as double) end as value, case when {skip} then 'SKIP' when {v} >= 0.9 then 'PASS' else 'FAIL' end as status")
    return " union all ".join(parts)


def _scorecard() -> str:
    u = _utility_parts()
    ctes = RHO + _findings_ctes() + ", ch as (select max(round(abs(y.rho - x.rho), 6)) as v from s_o x join s_a y on x.ca = y.ca and x.cb = y.cb)"
    parts = [f"select '{m}' as metric, item, status from ({sql})" for m, sql in u.items()]
    parts.append("select 'M6' as metric, 'max' as item, case when coalesce(v <= 0.05, false) then 'PASS' else 'FAIL' end as status from ch")
    parts.append(f"select 'M7' as metric, item, status from ({_findings()})")
    parts.append(f"select 'M9' as metric, item, status from ({_worst_cells()})")
    return _with(
        ctes + ", dt as (" + " union all ".join(parts) + ")",
        f"select metric, count(*) as items, {_n(chr(39).join(['sum((status = ', 'PASS', ')::int)']), 'passed')}, case when sum((status = 'FAIL')::int) > 0 then 'FAIL' when min(status) = 'SKIP' then 'SKIP' else 'PASS' end as status from dt group by metric",
    )


def _audit_summary() -> str:
    """On raw rows: T1 to T9 from the pieces above, with k of 3 in distinct subscribers."""
    base = ["time_start", "enb_id", "province", "radio_access_type"]
    sets = [base[:2], base, [*base, "application_category"], [*base, "application_category", *VOLUMES]]
    risk = " union all ".join(
        "select cl.k from timed t join (select " + _cols(k) + ", count(distinct msisdn) as k from timed group by all) cl on " + " and ".join(f"t.{_q(c)} is not distinct from cl.{_q(c)}" for c in k) for k in sets
    )
    ctes = (
        _relink_ctes()
        + _scan_ctes("raw")
        + _precision_ctes("raw")
        + ", pts as (select distinct msisdn as entity, time_start as h, enb_id as c from timed where enb_id is not null)"
        + f", t4 as (select p, eligible, unicity as u from ({_unicity_parts('pts', (4,), 500)[0]}))"
        + HOME[len(TIMED) :]
        + LABELS[len(ANON) :].replace("from anon", "from timed")
        + f", kr as ({risk})"
        + ", inf as (select * from (" + _inference_on("timed", "msisdn", "row_id") + "))"
    )
    s5 = f"(select avg((k < {K})::int) from res)"
    h, f = (f"(select coalesce(sum(case when {c} then n else 0 end) / greatest(sum(n), 1), 0) from lab where n >= {K})" for c in ("round(top, 9) > 0.9", "round(tvd, 9) > 0.3"))
    best, n = "(select max(round(top1, 6)) from relinked)", "(select max(subscribers) from relinked)"
    shape = _shape("msisdn", "msisdn")
    tests = {
        "T1": "(select case when max(round(share, 4)) filter (share > 0) >= 0.01 then 'FAIL' when max(share) > 0 then 'WARN' else 'PASS' end from scan)",
        "T2": f"(select status from ({shape}))",
        "T3": f"(select case when min(k) = 1 then 'FAIL' when avg((k < {K})::int) > 0.01 then 'WARN' else 'PASS' end from kr)",
        "T4": "(select case when eligible < 20 then 'SKIP' when round(u, 6) > 0.05 then 'FAIL' when round(u, 6) > 0.01 then 'WARN' else 'PASS' end from t4)",
        "T5": f"(select case when (select count(distinct hod) from timed) <= 1 then 'SKIP' else {_status(f'{s5} > 0.05', f'{s5} > 0.01')} end)",
        "T6": f"(select case when coalesce({n}, 0) < 50 then 'SKIP' else {_status(f'{best} > 0.05 and {best} * {n} > 10', f'{best} > 0.01 and {best} * {n} > 3')} end)",
        "T7": "(select case when sum((status = 'FAIL')::int) > 0 then 'FAIL' when sum((status = 'WARN')::int) > 0 then 'WARN' else 'PASS' end from ps)",
        "T8": f"(select {_status(f'{h} > 0.20', f'{h} > 0.05 or {f} > 0.20')})",
        "T9": "(select status from inf)",
    }
    rows = " union all ".join(f"select '{t}' as test, {e} as status" for t, e in tests.items())
    over = "select 'overall' as test, case when sum((status = 'FAIL')::int) > 0 then 'FAIL' when sum((status = 'WARN')::int) > 0 then 'WARN' else 'PASS' end as status from al"
    return _with(ctes + f", al as ({rows})", f"select * from al union all {over}")


def _inference_on(source: str, user: str, row: str) -> str:
    body = _inference()
    start = body.index(", t as (")
    inner = body[start + 2 :].replace("from anon)", f"from {source})").replace("md5('0:' || gt_user)", f"md5('0:' || {user})").replace("gt_row_id", row)
    return "with " + inner


def _headline() -> str:
    u = "select sum(case when n = 1 then n else 0 end) / sum(n) from (select count(*) as n from a group by " + _cols([*ATTACK_QI, "tac"]) + ")"
    hw = _home_work()
    hw_ctes = hw[len("with " + AR) : hw.index(" select label, case when users")]
    located = "(select coalesce(sum((users = 1 and hit = 1)::int), 0) from ev2 where label = 'home' and users = 1)"
    one = lambda line, v: f"select '{line}' as line, {_r(v, 'value')}"
    parts = [
        one("adjacent rows of one subscriber", "(select adj from ad)"),
        one("rows in classes of one subscriber", f"(select sum(case when u = 1 then n else 0 end) / sum(n) from (select count(*) as n, count(distinct gt_user) as u from a group by {_cols(ATTACK_QI)}))"),
        one("rows with a device type of one subscriber", "(select sum(case when u <= 1 then n else 0 end) / sum(n) from (select count(*) as n, count(distinct gt_user) as u from a group by tac))"),
        one("rows unique by keys and device type", f"({u})"),
        one("rows linked to the next hour", "(select hits / nullif(n, 0) from lk)"),
        one("subscribers located at home by device type", f"{located} / (select greatest(count(distinct gt_user), 1) from a)"),
        f"select 'subscribers identified by four points' as line, uniquely_identified as value from ({_points_parts((4,))[0]})",
    ]
    return _with(AR + ORDER + _linking_ctes().replace(", pr as", ", lpr as").replace("from pr where", "from lpr where") + hw_ctes + ", pts as (select distinct gt_user as entity, hour, cell, tac from r)", " union all ".join(f"select * from ({p})" for p in parts))


def _report() -> str:
    small = lambda n: f"cast(coalesce(sum((n{n} < {K})::int), 0) as bigint)"
    return _with(
        GEN + _walk(K, QI) + f", tt as (select {small(0)} as p0, {small(1)} as p1, {small(2)} as d, count(*) as n from w4)",
        "select 1 as step, 'restrict' as action, 'application_category' as \"column\", 'RESTRICTED' as sentinel, p0 as rows from tt where p0 > 0 union all select 2, 'restrict', 'enb_id', '0', p1 from tt where p0 > 0 and p1 > 0"
        " union all select 3, 'drop', null, null, d from tt union all select 4, 'keep', null, null, n - d from tt",
    )


def _cdf_points() -> str:
    shares = [i / 20 for i in range(21)]
    at = lambda t, c: f"(select unnest(quantile_cont({_q(c)}, {shares})) as v, unnest(range(0, 21)) as i from {t})"
    return " union all ".join(f"select '{c}' as item, {_r('i / 20', 'share')}, {_r('x.v + 1e-12', 'original')}, {_r('y.v + 1e-12', 'anonymised')} from {at('orig', c)} x join {at('rel', c)} y using (i)" for c in KPIS)


def _category_shares() -> str:
    parts = []
    for c in ("radio_access_type", "province", "application_category", "device_type"):
        n = lambda t: f"(select coalesce(cast({c} as varchar), 'nan') as label, count(*) as n from {t} group by 1)"  # noqa: B023, E731
        parts.append(f"select '{c}' as item, label, {_r('x.n / (select count(*) from orig)', 'original')}, {_r('coalesce(y.n, 0) / (select count(*) from rel)', 'anonymised')} from (select * from {n('orig')} order by n desc, label limit 15) x left join {n('rel')} y using (label)")
    return " union all ".join(f"select * from ({p})" for p in parts)


def oracles() -> dict[str, str]:
    util = _utility_parts()
    released = f"select row_id, {_cols(RELEASED)} from anon"
    raw_classes = f"select cast(floor(time_start / 3600) as bigint) as hour, province, radio_access_type, enb_id, application_category, count(*) as n, count(*) < {K} as small from raw group by all"
    few, one = f"u < {K}", "u = 1"
    share = lambda c: f"sum(case when {c} then n else 0 end) / sum(n)"
    tac_part = " union all ".join(
        f"select cast({m} as bigint) as max_users, {_r(f'sum(case when u <= {m} then n else 0 end) / sum(n)', 'rows_share')}, {_r(f'(select count(distinct gt_user) from a where tac in (select tac from tt where u <= {m})) / (select count(distinct gt_user) from a)', 'users_share')} from tt"
        for m in (1, 3, 5, 10)
    )
    flags = {"tethering": "tethering_data_GB_dl_sum", "video": "im_video_GB_sum", "audio": "im_audio_GB_sum"}
    flag_part = " union all ".join(
        f"select '{f}' as flag, {_r('avg(x)', 'overall_rate')}, {_r('avg((m = 1 and n >= 2)::int)', 'rows_all_positive')}, {_r('avg((m = 0 and n >= 2)::int)', 'rows_all_negative')} from (select x, avg(x) over w as m, count(*) over w as n from (select *, (coalesce({_q(c)}, 0) > 0)::int as x from a) window w as (partition by {_cols(ATTACK_QI)}))"
        for f, c in flags.items()
    )
    excess = " union all ".join(f"select '{c}' as \"column\", {_r(f'avg((abs({_sig(_q(c))} - {_q(c)}) > 1e-9 * abs({_q(c)}))::int)', 'share')} from a where {_q(c)} <> 0 having count(*) > 0" for c in KPIS)
    return {
        "qi_class_sizes": _with(RAW, raw_classes),
        "sig_round_kpis": _with(RAW, "select row_id, " + ", ".join(f"{_sig(_q(c))} as {_q(c)}" for c in KPIS) + " from raw"),
        "imei_tac": _with(RAW, f"select row_id, {_TAC} as tac, cast(floor(time_start / 3600) as bigint) as hour from raw"),
        "ground_truth": _with(RAW, "select row_id, msisdn as gt_user, row_id as gt_row_id from raw"),
        "hash_sample": _with(RAW, f"select row_id from raw order by {_draw('row_id')}, row_id limit 500"),
        "original_columns": _with(RAW, "select row_id, cast(enb_id as varchar) as enb_id, province, radio_access_type, application_category from raw"),
        "release_columns": _with(ANON, "select row_id, imei, cast(enb_id as varchar) as enb_id, province, radio_access_type, application_category from anon"),
        "release_candidate": _with(ANON, released),
        "release_candidate_tac": _with(GEN + _walk(2, [*QI, "imei"]), released),
        "release_by_windows": _with(ANON, "select row_id, application_category, enb_id from anon"),
        "suppression_report": _report(),
        "k_risk_rows": _risk(False),
        "k_risk_users": _risk(True),
        "k_distinct_users": _with(A, f"select count(*) as classes, {_r(f'avg(({few})::int)', 'share_classes_users_lt_k')}, {_r(share(few), 'share_rows_users_lt_k')}, {_r(share(one), 'share_rows_single_user')}, {_r('median(n / u)', 'median_rows_per_user')} from (select count(*) as n, count(distinct gt_user) as u from a group by {_cols(ATTACK_QI)})"),
        "tac_sharing": _with(A + ", tt as (select tac, count(*) as n, count(distinct gt_user) as u from a group by tac)", tac_part),
        "row_uniqueness": _uniqueness(),
        "equivalence_report": _equivalence(),
        "violating_rows": _violating(),
        "linkage_overview": _with(ANON, "select count(*) as n_rows, count(distinct time_start) as n_hours, count(distinct enb_id) as distinct_cells, count(distinct imei) as distinct_devices from anon"),
        "t_closeness": _t_closeness(),
        "class_label_distances": _with(LABELS, f"select time_start, enb_id, province, radio_access_type, n, {_r('top', 'top')}, {_r('tvd', 'tvd')} from lab"),
        "l_diversity_flags": _with(A, flag_part),
        "inference_attack": _inference(),
        "unicity": _unicity(),
        "home_cell_exposure": _home_exposure(),
        "home_work_by_tac": _home_work(),
        "point_uniqueness": _with(POINTS, " union all ".join(_points_parts((1, 2, 3, 4)))),
        "unique_runs": _over_keys(lambda i, k: f"select '{_name(k)}' as link_key, (select count(*) from anon) as rows, cast(coalesce(sum(length), 0) as bigint) as unambiguous_rows, count(*) as runs from l{i}"),
        "next_hour_links": _over_keys(_next_hour),
        "chain_histogram": _over_keys(lambda i, k: f"select '{_name(k)}' as link_key, length, count(*) as chains from l{i} group by length order by length limit 24"),
        "chain_unicity": _chain_unicity(),
        "suppression_footprint": _footprint(),
        "cell_recovery": _cell_recovery(),
        "restricted_baseline": _with(AR, f"select cast(coalesce(sum(n), 0) as bigint) as restricted_rows, {_r('max(n) / sum(n)', 'majority_baseline')} from (select r.application_category as l, count(*) as n from a join r on r.gt_row_id = a.gt_row_id where a.app_gone group by 1)"),
        "hour_province_diff": _with(AR + HP, "select * from hp"),
        "identifier_scan": _with(RAW + _scan_ctes("raw"), f'select col as "column", pattern, {_r("share", "share", 4)} from scan where share > 0'),
        "pseudonym_shape": _with(RAW, _shape("msisdn", "msisdn") + " union all " + _shape("token", "sha256(msisdn)")),
        "pseudonym_enumeration": _enumeration(),
        "pseudonym_enumeration_whole": _enumeration(3_000_000),
        "value_precision": _precision(RAW, "raw"),
        "value_precision_release": _precision(ANON, "anon"),
        "metric_relink": _with(_relink_ctes(), f"select variant, subscribers, {_r('top1', 'top1')}, {_r('top5', 'top5')} from relinked"),
        "hourly_row_linking": _with(A + _linking_ctes(), f"select {_LK}"),
        "row_order_leak": _with(A + ORDER, f"select {_r('adj', 'adjacent_same_user')}, {_r('e', 'expected_if_shuffled')}, adj > greatest(3 * e, 0.01) as leak, {_r('srt', 'time_sorted_share')} from ad, ex"),
        "excess_precision": _with(A, excess),
        "column_flags": (
            "select case when column_name in ('msisdn', 'imsi') then 'direct_id_columns_present' else 'index_like_columns' end as kind, column_name as \"column\" "
            f"from (describe with {RAW} select * from raw) where lower(column_name) in ('msisdn', 'imsi', 'index', 'id', 'row_id') or lower(column_name) like 'unnamed%'"
        ),
        "device_lengths": _with(A, "select length(imei) as length, count(*) as rows from a where imei is not null group by 1 order by rows desc, length limit 5"),
        "attack_headline": _headline(),
        "audit_summary": _audit_summary(),
        "profile_base": _profile_base(),
        "profile_categories": _profile_categories(),
        "profile_cell_histogram": _with(ANON + ", cs as (select count(*) as n from anon where enb_id is not null group by enb_id)", "select 'enb_id' as \"column\", '1' as bucket, count(*) as cells from cs where n = 1 union all select 'enb_id', '2-9', count(*) from cs where n between 2 and 9 union all select 'enb_id', '>=10', count(*) from cs where n >= 10"),
        "profile_numeric": _profile_numeric(ANON, "anon", KPIS),
        "profile_numeric_lineitem": _profile_numeric("", "lineitem", ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
        "device_type": _with(UTIL, "select row_id, device_type from rel"),
        "row_retention": _with(UTIL, util["M1"]),
        "kpi_completeness": _with(UTIL, util["M3"]),
        "ks_fidelity": _with(UTIL, util["M4"]),
        "cdf_points": _with(UTIL, _cdf_points()),
        "category_shares": _with(UTIL, _category_shares()),
        "jsd_categorical": _with(UTIL, util["M5"]),
        "spearman_delta": _with(RHO, f"select {_NAMES}[x.ca + 1] as a, {_NAMES}[x.cb + 1] as b, {_r('x.rho', 'original')}, {_r('y.rho', 'anonymised')}, {_r('abs(y.rho - x.rho)', 'change')} from s_o x join s_a y on x.ca = y.ca and x.cb = y.cb"),
        "finding_gap": _with(UTIL + _findings_ctes(), _findings()),
        "worst_cell_recall": _with(UTIL, _worst_cells()),
        "utility_scorecard": _scorecard(),
        "share_check": "select user_id as review_id, case when user_id % 3 = 0 then 'raw' else 'release_candidate' end as subject, cast(sum((event_type = 'error' and v <= 480)::int) as bigint) as blockers, user_id % 3 <> 0 and sum((event_type = 'error' and v <= 480)::int) = 0 as shareable from (select user_id, event_type, max(value) as v from events group by all) group by user_id",
    }


