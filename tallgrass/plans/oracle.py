"""The same queries as SQL over the same tables, written independently.

The SQL runs in DuckDB, with one view per table.
"""

from __future__ import annotations

from tallgrass.functions.permute import ROUNDS, WALKS, round_keys
from tallgrass.plans.queries import (
    BATCHES, BOXES, EPOCHS, MODEL_FACTORS, NATIONS, PANES, PMI_THRESHOLD, SEED, SHIP_DATE, SOURCES,
)

ON_DATE = f"l_shipdate = timestamp '{SHIP_DATE} 00:00:00'"

# ---- relational reports ----

Q6 = f"""
select l_returnflag, l_linestatus,
       round(sum(l_quantity), 4) as sum_qty,
       round(sum(l_extendedprice), 4) as sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 4) as sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 4) as sum_charge,
       round(avg(l_quantity), 4) as avg_qty,
       round(avg(l_extendedprice), 4) as avg_price,
       round(avg(l_discount), 4) as avg_disc,
       count(*) as count_order
from lineitem where {ON_DATE}
group by l_returnflag, l_linestatus order by 1, 2
"""

RELATIONAL = {
    "q1_count_shipdate": f"select count(*) as n_lines from lineitem where {ON_DATE}",
    "q2_orders_on_date": f"""
        select o_orderkey, o_orderpriority from orders
        where o_orderkey in (select l_orderkey from lineitem where {ON_DATE})
        order by o_orderkey, o_orderpriority limit 20""",
    "q3_parts_suppliers": f"""
        select l_orderkey, p_name, s_name
        from lineitem join part on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey
        where {ON_DATE} order by l_orderkey, p_name, s_name limit 20""",
    "q4_shipments_by_nation": f"""
        select n_nationkey, n_name, count(*) as n_lines
        from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
             join nation on n_nationkey = c_nationkey
        where {ON_DATE} group by n_nationkey, n_name order by n_nationkey""",
    "q5_shipments_by_month": f"""
        select n_nationkey, n_name, strftime(l_shipdate, '%Y-%m') as month, count(*) as n_lines
        from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
             join nation on n_nationkey = c_nationkey
        where n_name in {NATIONS} group by 1, 2, 3 order by 1, 3""",
    "q6_pricing_summary": Q6,
    "q6_from_text": Q6,
}

# ---- words ----

TOKENS_OF = r"""list_filter(list_transform(string_split_regex(lower({0}), '[ \t\n\x0B\f\r]+'),
    lambda w: regexp_replace(w, '^[^a-z]+|[^a-z]+$', '', 'g')), lambda w: w <> '')"""

LINES = f"""
lines as materialized (
  select doc_id, line_no, {TOKENS_OF.format('value')} as t
  from (select doc_id, generate_subscripts(l, 1) - 1 as line_no, unnest(l) as value
        from (select doc_id, string_split(text, chr(10)) as l from documents))
)"""

HEADS = """
heads as materialized (
  select distinct doc_id, line_no, stretch, w
  from (select doc_id, line_no, (generate_subscripts(t, 1) - 1) // 40 as stretch, unnest(t) as w from lines)
),
total as materialized (select sum(greatest(ceil(len(t) / 40.0), 1)) as n from lines),
words as materialized (select w, count(*) as n from heads group by w)"""

PAIRS = f"""
pairs as materialized (
  select a.w as x, b.w as y, count(*) as n
  from heads a join heads b on a.doc_id = b.doc_id and a.line_no = b.line_no and a.stretch = b.stretch and a.w <> b.w
  group by 1, 2 having count(*) >= {PMI_THRESHOLD}
),
scored as (
  select x, y, p.n, round(log10(p.n::double * (select n from total) / (a.n::double * b.n)), 6) + 0.0 as pmi
  from pairs p join words a on a.w = x join words b on b.w = y
)"""

BIGRAMS = """
bigrams as materialized (
  select x, y, count(*) as n
  from (select unnest(t[1:-2]) as x, unnest(t[2:]) as y from lines where len(t) > 1)
  group by x, y
),
freqs as (
  select x, y, n, m.marginal, round(n / m.marginal, 9) as freq
  from bigrams join (select x, sum(n)::bigint as marginal from bigrams group by x) m using (x)
)"""

WORDS = {
    "tokens": f"""with {LINES}
        select doc_id, line_no::int as line_no, (generate_subscripts(t, 1) - 1)::int as pos, unnest(t) as token
        from lines""",
    "line_counts": f"with {LINES} select count(*) as n_lines from lines",
    "word_line_freq": f"with {LINES}, {HEADS} select w, n from words",
    "pair_counts": f"with {LINES}, {HEADS}, {PAIRS} select x, y, n from pairs",
    "pmi_pairs": f"with {LINES}, {HEADS}, {PAIRS} select x, y, pmi, n from scored",
    "pmi_stripes": f"""with {LINES}, {HEADS}, {PAIRS}
        select x, y, pmi, n from scored""",
    "bigram_freq": f"with {LINES}, {BIGRAMS} select x, y, n, marginal, freq from freqs",
    "bigram_marginals": f"""with {LINES}, {BIGRAMS}
        select x, y, n from bigrams
        union all select x, '*' as y, sum(n)::bigint as n from bigrams group by x""",
    "bigram_stripes": f"with {LINES}, {BIGRAMS} select x, y, freq from freqs",
}

# ---- index and retrieval ----

TF = f"""
tf as materialized (
  select term, doc_id, count(*) as tf
  from (select doc_id, unnest({TOKENS_OF.format('text')}) as term from documents) group by 1, 2
)"""
BLOCKED = "(select *, floor(doc_id / 262144.0)::bigint as block from tf)"


def _with(term: str) -> str:
    return f"select doc_id from tf where term = '{term}'"


NESTED = f"(({_with('the')} intersect {_with('and')}) union {_with('une')})"

INDEX = {
    "doc_tf": f"with {TF} select term, doc_id, tf from tf",
    "doc_freq": f"with {TF} select term, count(*) as df from tf group by term",
    "postings": f"""with {TF}
        select term, block, string_agg(doc_id || ':' || tf, ' ' order by doc_id) as postings
        from {BLOCKED} group by 1, 2""",
    "postings_gaps": f"""with {TF}
        select term, block, string_agg(gap || ':' || tf, ' ' order by doc_id) as gaps
        from (select *, doc_id - coalesce(lag(doc_id) over (partition by term, block order by doc_id), 0) as gap
              from {BLOCKED})
        group by 1, 2""",
    "postings_decoded": f"with {TF} select term, doc_id, tf from tf",
    "bool_and": f"with {TF} {_with('the')} intersect {_with('and')} order by doc_id",
    "bool_or": f"with {TF} {_with('avec')} union {_with('der')} order by doc_id",
    "bool_nested": f"with {TF} select doc_id from {NESTED} order by doc_id",
    "bool_nested_sets": f"with {TF} select doc_id from {NESTED} order by doc_id",
    "bool_snippets": f"""with {TF}
        select doc_id, case when length(text) > 80 then substr(text, 1, 80) || '...' else text end as snippet
        from documents where doc_id in (select doc_id from {NESTED}) order by doc_id""",
}

# ---- graph ----

ONE_WAY = "select l_suppkey as src, l_partkey as dst from lineitem"
BOTH_WAYS = f"{ONE_WAY} union all select l_partkey, l_suppkey from lineitem"


CUSTOMERS = "select c_custkey as id from customer"
ORDER_NODES = "select o_orderkey as id from orders"
ORDER_EDGES = "select o_orderkey as src, o_custkey as dst from orders"


def _graph(edges: str, nodes: str = CUSTOMERS) -> str:
    return f"""
    nodes as materialized ({nodes}),
    edges as materialized (select src, dst, count(*) as w from ({edges}) where src in (select id from nodes) group by 1, 2),
    degrees as materialized (select src, sum(w) as d from edges group by src),
    sources as (select unnest([{', '.join(f'{s}::bigint' for s in SOURCES)}]) as source)"""


def _ranks(edges: str, iterations: int, nodes: str = CUSTOMERS) -> str:
    """One pair of CTEs per iteration; the last one is ``p{iterations}``."""
    parts = [
        _graph(edges, nodes),
        "p0 as materialized (select id, source, (id = source)::int::double as p from nodes, sources)",
    ]
    for i in range(1, iterations + 1):
        parts.append(f"""
        in{i} as materialized (
          select id, s.source, coalesce(m.mass, 0.0) as mass
          from nodes cross join sources s left join (
            select dst, source, sum(p * w / d) as mass
            from p{i - 1} join edges on src = id join degrees using (src) group by 1, 2
          ) m on m.dst = id and m.source = s.source
        ),
        lost{i} as materialized (select source, greatest(0.0, 1 - sum(mass)) as lost from in{i} group by source),
        p{i} as materialized (
          select id, source,
                 0.85 * (mass + case when id = source then lost else 0 end) + case when id = source then 0.15 else 0 end as p
          from in{i} join lost{i} using (source)
        )""")
    return "with " + ",".join(parts)


GRAPH = {
    "graph_stats": f"""with {_graph(ONE_WAY)}
        select count(*) as nodes, sum(coalesce(d, 0))::bigint as edges, count(d) as active_nodes,
               count(*) - count(d) as dangling_nodes
        from nodes left join degrees on src = id""",
    "graph_orphans": f"""with {_graph(BOTH_WAYS)}
        select dst, sum(w)::bigint as edges from edges where dst not in (select id from nodes) group by dst""",
    "adjacency_bad_lines": """
        select o_orderkey || ' ' || o_orderpriority as bad_line from orders where o_custkey % 2 <> 0""",
    "adjacency_edges": """
        select src, dst, count(*) as n
        from (select l_partkey as src, l_suppkey as dst from lineitem
              union all select l_partkey, l_orderkey from lineitem)
        group by 1, 2""",
    "ppr_iter1": f"{_ranks(BOTH_WAYS, 1)} select id, source, round(p, 9) as score from p1",
    "ppr_iter5": f"{_ranks(BOTH_WAYS, 5)} select id, source, round(p, 9) as score from p5",
    "ppr_dangling": f"{_ranks(ONE_WAY, 3)} select id, source, round(p, 9) as score from p3",
    "ppr_from_adjacency": f"{_ranks(ORDER_EDGES, 4, ORDER_NODES)} select id, source, round(p, 9) as score from p4",
    "ppr_top_nodes": f"""{_ranks(BOTH_WAYS, 5)}
        select * from (
          select source, row_number() over (partition by source order by score desc, id)::int as rank, id, score
          from (select id, source, round(p, 9) as score from p5))
        where rank <= 10""",
    "ppr_report": f"""{_ranks(BOTH_WAYS, 5)}
        select source, rank, printf('%.5f %d', score, id) as line from (
          select source, row_number() over (partition by source order by score desc, id)::int as rank, id, score
          from (select id, source, round(p, 9) as score from p5))
        where rank <= 10""",
    "ppr_missing_mass": f"""{_ranks(BOTH_WAYS, 2)}
        select source, round(sum(mass), 9) as arrived, round(greatest(0.0, 1 - sum(mass)), 9) + 0.0 as missing,
               count(*) filter (mass > 0) as reached_nodes
        from in2 group by source""",
}

for _i, _head in ((1, ""), (2, " union all "), (3, " union all ")):
    GRAPH["ppr_counters"] = GRAPH.get("ppr_counters", _ranks(BOTH_WAYS, 3)) + f"""{_head}
        select {_i} as iteration, source, (select count(*) from nodes) as nodes,
               (select count(distinct id) from in{_i} where mass > 0) as reached,
               round(sum(mass), 9) + 0.0 as arrived, round(greatest(0.0, 1 - sum(mass)), 9) + 0.0 as missing
        from in{_i} group by source"""
GRAPH["ppr_log"] = f"{_ranks(BOTH_WAYS, 4)} select id, source, round(p, 9) as score from p4 where p > 0"

# ---- classifier ----

# The permutation: halves of the bits of the largest index, changed in turns; again until inside.
_KEYS = round_keys(SEED)
_A, _B = ([k[i] for k in _KEYS] for i in (0, 1))


def _order(rows: str) -> str:
    network = f"""list_reduce(range({ROUNDS}), lambda s, i: case when i % 2 = 0
        then s - s % low + xor(s % low, (((s // low) * {_A}[i + 1] + {_B}[i + 1]) >> 11) % low)
        else xor(s // low, (((s % low) * {_A}[i + 1] + {_B}[i + 1]) >> 11) % high) * low + s % low end, {{x}})"""
    walk = f"list_reduce(range({WALKS}), lambda v, _: case when v < n then v else {network.format(x='v')} end, {network.format(x='idx')})"
    return f"""
    numbered as (select *, row_number() over (order by doc_id nulls first) - 1 as idx, count(*) over () as n from {rows}),
    halves as (select *, length(bin(n - 1)) as bits, (1::bigint << (length(bin(n - 1)) // 2)) as low,
               (1::bigint << (length(bin(n - 1)) - length(bin(n - 1)) // 2)) as high from numbered),
    placed as materialized (select * exclude (idx, bits, low, high), ({walk})::bigint as position from halves)"""


FEATURES = f"""
occ as materialized (
  select doc_id, ('0x' || substr(md5(w), 1, 4))::int as feature
  from (select doc_id, unnest({TOKENS_OF.format('text')}) as w from documents)
),
labelled as (select doc_id, case when toxic = 1 then 'spam' else 'ham' end as label
             from labels where doc_id in (select doc_id from documents))"""

MODELS = f"""
models as materialized (
  select 'm' || k as model_id, feature, ((feature * k) % 201 - 100) / 1024 as weight
  from (select distinct feature from occ where doc_id in (select doc_id from labelled)),
       (select unnest({list(MODEL_FACTORS)}) as k)
),
docs as (select doc_id, coalesce(label, 'ham') as label from documents left join labelled using (doc_id)),
scores as materialized (
  select doc_id, label, model_id, coalesce(sum(weight), 0) as score
  from docs cross join (select distinct model_id from models) ids
       left join occ using (doc_id) left join models using (model_id, feature)
  group by 1, 2, 3
)"""


def _steps(steps: int, batches: int = 1) -> str:
    """``w{steps}``: weights after so many steps, each over one batch of consecutive places of the random order."""
    parts = [
        FEATURES,
        _order("labelled"),
        f"""times as materialized (select doc_id, (label = 'spam')::int as y, position * {batches} // n as batch, feature, count(*) as t
           from occ join placed using (doc_id) group by 1, 2, 3, 4)""",
        "w0 as (select distinct feature, 0.0::double as weight from times)",
    ]
    for i in range(1, steps + 1):
        parts.append(f"""
        r{i} as materialized (select doc_id, y - 1 / (1 + exp(-sum(t * weight))) as r
               from times join w{i - 1} using (feature) where batch = {(i - 1) % batches} group by doc_id, y),
        g{i} as materialized (select feature, sum(t * r) as g from times join r{i} using (doc_id) group by feature),
        w{i} as materialized (select feature, weight + 0.002 * coalesce(g, 0) as weight
               from w{i - 1} left join g{i} using (feature))""")
    return "with " + ",".join(parts)


LABEL = "case when score > 0 then 'spam' else 'ham' end as predicted"

CLASSIFIER = {
    "features": f"""with {FEATURES}
        select doc_id, label, feature, count(*) as n from occ join labelled using (doc_id) group by 1, 2, 3""",
    "train_epochs": f"{_steps(EPOCHS)} select feature, round(weight, 9) + 0.0 as weight from w{EPOCHS}",
    "train_batches": f"{_steps(BATCHES, BATCHES)} select feature, round(weight, 9) + 0.0 as weight from w{BATCHES}",
    "random_order": f"with {_order('(select doc_id from documents)')} select doc_id, position from placed",
    "score_docs": f"""with {FEATURES}, {MODELS}
        select doc_id, label, round(score, 6) + 0.0 as score, {LABEL} from scores where model_id = 'm{MODEL_FACTORS[0]}'""",
    "ensemble_average": f"""with {FEATURES}, {MODELS}
        select doc_id, label, round(score, 6) + 0.0 as score, {LABEL}
        from (select doc_id, label, sum(score) / count(*) as score from scores group by 1, 2)""",
    "ensemble_vote": f"""with {FEATURES}, {MODELS}
        select doc_id, label, score, {LABEL}
        from (select doc_id, label, sum(case when score > 0 then 1.0 else -1.0 end)::double as score
              from scores group by 1, 2)""",
}

# ---- events ----

POINTS = "select ts, event_type, value as x, (props->>'$.k')::double as y from events"


def _box(name: str, box, x: str, y: str) -> str:
    return (
        f"when {x} > {box.x_min} and {x} < {box.x_max} and {y} > {box.y_min} and {y} < {box.y_max} then '{name}'"
    )


def _located(x: str = "x", y: str = "y") -> str:
    cases = " ".join(_box(b.name, b, x, y) for b in BOXES)
    return f"select * from (select *, case {cases} end as region from ({POINTS})) where region is not null"


def _counts(events: str, size: str) -> str:
    """Windows start at multiples of their size counted from the epoch."""
    start = f"time_bucket(interval '{size}', ts, timestamp '1970-01-01')"
    return f"""
        select {start}::varchar as window_start, ({start} + interval '{size}')::varchar as window_end,
               region, count(*) as n
        from ({events}) group by 1, 2, 3"""


ALL_COUNTS = _counts("select *, 'all' as region from events", "1 hour")
REGION_COUNTS = _counts(_located(), "1 hour")

FILLED = f"""
hits as (select time_bucket(interval '6 hours', ts, timestamp '1970-01-01') as s, region, count(*) as n
         from ({_located()}) group by 1, 2),
bounds as (select region, min(s) as first,
                  (select time_bucket(interval '6 hours', max(ts), timestamp '1970-01-01') from events) as last
           from hits group by region),
spine as (select region, unnest(generate_series(first, last, interval '6 hours')) as s from bounds),
filled as (select s, s + interval '6 hours' as e, region, coalesce(n, 0) as n from spine left join hits using (region, s))"""

TRENDING = f"""with {FILLED},
    compared as (select region, e, n as current,
                        coalesce(lag(n) over (partition by region order by s), 0) as previous from filled),
    judged as (select *, current >= 10 and current >= 2 * previous as is_trending from compared)
    select region, e::varchar as window_end, current, previous, is_trending,
           case when is_trending then
             'Number of arrivals to ' || case region when 'box_a' then 'Box A' else 'Box B' end ||
             ' has doubled from ' || previous || ' to ' || current || ' at ' || epoch_ms(e) || '!' end as message
    from judged"""

BOX_C = "x > 15 and x < 45 and y > 30 and y < 80"


def _inside(i: int) -> str:
    b = BOXES[i]
    return f"x > {b.x_min} and x < {b.x_max} and y > {b.y_min} and y < {b.y_max}"


SLIDING = f"""
    select s::varchar as window_start, (s + interval '1 hour')::varchar as window_end, count(*) as n
    from (select unnest(generate_series(b - interval '15 minutes' * {PANES - 1}, b, interval '15 minutes')) as s
          from (select time_bucket(interval '15 minutes', ts, timestamp '1970-01-01') as b from events))
    group by 1, 2"""

EVENTS = {
    "event_counts": ALL_COUNTS,
    "region_counts": REGION_COUNTS,
    "region_counts_by_type": _counts(
        _located("(case when event_type = 'click' then x else y end)", "(case when event_type = 'click' then y else x end)"),
        "1 hour",
    ),
    "region_matches": f"""
        select 'box_a' as region, count(*) as n from ({POINTS}) where {_inside(0)}
        union all select 'box_b', count(*) from ({POINTS}) where {_inside(1)}
        union all select 'box_c', count(*) from ({POINTS}) where {BOX_C}""",
    "region_table_matches": f"""
        select s_suppkey::varchar as region, count(*) as n
        from ({POINTS}) join supplier
          on x > s_suppkey * 7 % 90 and x < s_suppkey * 7 % 90 + 3.5 and y > s_suppkey * 13 % 80 and y < s_suppkey * 13 % 80 + 12.5
        group by 1""",
    "region_counts_zero_filled": f"""with {FILLED}
        select s::varchar as window_start, e::varchar as window_end, region, n from filled""",
    "sliding_counts": SLIDING,
    "trending": TRENDING,
    "stream_sliding_counts": SLIDING,
    "stream_trip_counts": _counts(_located().replace("select ts,", "select date_trunc('day', ts) as ts,"), "1 day"),
    "stream_event_counts": ALL_COUNTS,
    "stream_region_counts": REGION_COUNTS,
    "stream_trending": TRENDING,
}


# Queries that store their input in another form first: the same results.
STORED = {f"{name.split('_')[0]}_text_files": sql for name, sql in RELATIONAL.items()} | {
    f"stored_{name}": INDEX[name] for name in ("doc_freq", "bool_nested", "bool_snippets")
}


def all_sql() -> dict[str, str]:
    return {**RELATIONAL, **WORDS, **INDEX, **STORED, **GRAPH, **CLASSIFIER, **EVENTS}
