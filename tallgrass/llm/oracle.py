"""DuckDB SQL of the operators that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
with rows as (select doc_id, {_LOWER} as content from documents),
groups as (select content, max(doc_id) as keep_id, count(*) as group_size from rows group by content)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(content) as text_sha256
from rows join groups using (content)
"""

# Levels: what is left per unit of weight once the sources before are full.
OP3 = r"""
with rows as (
  select doc_id, coalesce('a' || source, 'b') as s, source, md5(doc_id::varchar) as digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sizes as (select s, sum(size)::bigint as source_size from rows group by s),
weighed as (
  select *, source_size * 2.0::double as cap,
         case (row_number() over (order by s) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as w
  from sizes),
levels as (
  select *, ((sum(source_size) over ())::double * 1.5::double - sum(cap) over f + cap) / (sum(w) over () - sum(w) over f + w) as level
  from weighed window f as (order by cap / w, s)),
goals as (select s, source_size, least(cap, max(level) over () * w) as target from levels),
placed as (
  select *, (sum(size) over (partition by s order by digest, doc_id, size rows unbounded preceding))::bigint as stop from rows),
takes as (select *, least(round(target)::bigint, 2 * source_size) as take from goals)
select doc_id, size, source_size, target,
       (case when size = 0 then 0 else (take // source_size) * size
         + greatest(least(stop, take % source_size) - (stop - size), 0) end)::bigint as taken, source
from placed join takes using (s)
"""



# ---- vector codes ----

PARTS, ENTRIES, ROUNDS = 16, 64, 2
# Distance of a part p to an entry c, both lists.
_APART = "list_sum(list_transform(range(1, len(p) + 1), lambda i: (p[i] - c[i]) * (p[i] - c[i])))"


def _nearest(books: str) -> str:
    return f"""select vec_id, part, p, min(struct_pack(d := coalesce({_APART}, 0)::bigint, e := entry)) as near
               from parts join {books} using (part) group by vec_id, part, p"""


def _codes() -> str:
    steps = [
        """usable as (
          select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as v from embeddings
          where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""parts as materialized (
          select vec_id, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] as p
          from usable, (select unnest(range({PARTS})) as part))""",
        f"""b0 as materialized (
          select part, row_number() over (partition by part order by vec_id) - 1 as entry, p as c
          from parts where vec_id in (select vec_id from usable order by vec_id limit {ENTRIES}))""",
    ]
    for i in range(ROUNDS):
        steps.append(f"n{i} as materialized ({_nearest(f'b{i}')})")
        steps.append(f"""sums{i} as (
          select part, near.e as entry, dims.at as dim, floor(sum(p[dims.at])::double / count(*))::bigint as mean
          from n{i}, (select unnest(range(1, 1 + (select max(len(p)) from parts))) as at) dims group by 1, 2, 3)""")
        steps.append(f"""b{i + 1} as materialized (
          select part, entry, coalesce(m, c) as c from b{i}
          left join (select part, entry, list(mean order by dim) as m from sums{i} group by 1, 2) using (part, entry))""")
    steps.append(f"final as materialized ({_nearest(f'b{ROUNDS}')})")
    steps.append("""coded as materialized (
        select vec_id, string_agg(printf('%02x', near.e), '' order by part) as code, sum(near.d)::bigint as error
        from final group by vec_id)""")
    digest = f"select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) from b{ROUNDS}"
    return f"""with {', '.join(steps)}
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, ({digest}) as codebooks_sha256
        from coded join usable using (vec_id)"""


# ---- conversations ----

_CONTROL = r"[<\[]\\*(\||/?s>|/?INST\]|</?SYS>>)"


def _broken(column: str) -> str:
    """Code points of a text whose control strings are broken by one more character each."""
    return f"(length({column}) + len(regexp_extract_all({column}, '{_CONTROL}')))"


OP12 = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
learned as (select *, case when role = 'assistant' then text else '' end as loss from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       sum(length(loss))::bigint as loss_chars, sha256(string_agg(loss, '' order by turn, role, text)) as loss_sha256,
       sum({_broken('role')} + {_broken('text')} + length('<|im_start|><|im_sep|><|im_end|>') + 1)::bigint as formatted_chars,
       0::bigint as n_attachments, 0::bigint as expanded_tokens
from learned group by conv_id
"""

# ---- Merkle manifest ----

LEVELS, SOURCE_LEVELS = 10, 5


def _h(*texts: str) -> str:
    return f"sha256({' || '.join(texts)})"


def _leaf(text: str) -> str:
    fields = [f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return _h(*fields)


def _climb(name: str, leaves: str, levels: int) -> list[str]:
    """Levels ``{name}0``, … of ``(s, i, n, h)`` with the others of a node's run; a tree of one node stays as it is."""
    steps = [f"{name}0 as materialized ({leaves})"]
    for k in range(levels):
        run = "partition by s, i // 3 order by i rows between"
        steps.append(f"""{name}side{k} as materialized (
          select s, i, n, coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') as l,
                 coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') as r
          from {name}{k})""")
        steps.append(f"""{name}{k + 1} as materialized (
          select s, i // 3 as i, (n + 2) // 3 as n, case when n = 1 then min(h) else sha256(string_agg(h, '' order by i)) end as h
          from {name}{k} group by s, i // 3, n)""")
    return steps


def _walk(name: str, start: str, levels: int) -> str:
    """Fold ``acc`` and collect ``path`` of rows ``(s, i, …)`` through all levels."""
    found = start
    for k in range(levels):
        found = f"""(select w.* replace (w.i // 3 as i, case when d.n = 1 then w.acc else sha256(d.l || w.acc || d.r) end as acc,
            case when d.n = 1 then w.path else w.path || d.l || d.r end as path)
          from {found} w join {name}side{k} d using (s, i))"""
    return found


def _merkle() -> str:
    # The checksum, bit by bit: bytes of the decimal id, eight shifts each.
    shift = "list_reduce(range(8), lambda v, _: case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end, xor(c, b)::bigint)"
    digits = "list_transform(string_split(doc_id::varchar, ''), lambda t: ascii(t)::bigint)"
    without = "replace(text, chr(10), '')"
    crc = f"xor(list_reduce({digits}, lambda c, b: {shift}, 4294967295::bigint), 4294967295)"
    steps = [
        f"hashed as materialized (select doc_id, coalesce('=' || source, '-') as s, {_leaf('text')} as h, "
        f"case when {crc} % 2 = 0 then {_leaf(without)} else {_leaf('text')} end as acc from documents)",
        "rows as materialized (select *, row_number() over (partition by s order by doc_id nulls first, h) - 1 as i, "
        "count(*) over (partition by s) as n from hashed)",
        *_climb("a", "select s, i, n, h from rows", LEVELS),
        *_climb("b", f"select 0 as s, s as tree, row_number() over (order by s) - 1 as i, count(*) over () as n, h from a{LEVELS}", SOURCE_LEVELS),
    ]
    low = _walk("a", "(select doc_id, s, s as tree, i, h as leaf, acc, '' as path from rows)", LEVELS)
    steps.append(f"low as materialized (select * from {low})")
    joined = f"""(select l.doc_id, 0 as s, t.i, l.leaf, t.h as subroot, l.acc, l.path
        from low l join b0 t on l.tree = t.tree)"""
    steps.append(f"high as (select * from {_walk('b', joined, SOURCE_LEVELS)})")
    return f"""with {', '.join(steps)}
        select doc_id, leaf, subroot, (select min(h) from b{SOURCE_LEVELS}) as root, sha256(path) as proof_sha256,
               acc as folded_root, acc = (select min(h) from b{SOURCE_LEVELS}) as verified
        from high"""


def all_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": OP2,
        "op3_mix_sources": OP3,
        "op11_vector_codes": _codes(),
        "op12_chat_format": OP12,
        "op13_merkle": _merkle(),
    }
