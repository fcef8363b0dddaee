"""The results of the Merkle manifest and of chat formatting stated in SQL."""

from __future__ import annotations

#: Levels written out below: 16 ** 5 rows of a source, 16 ** 4 sources.
LEVELS, TOP_LEVELS = 5, 4


def _tree(name: str, leaves: str, levels: int) -> str:
    """CTEs of the nodes by level over ``leaves`` (g, n, idx, d), and of the roots by g."""
    parts, previous = [f"{name}0 as (select g, n, idx, d from {leaves})"], f"{name}0"
    roots = [f"select g, d from {name}0 where n <= 1"]
    for k in range(1, levels + 1):
        parts.append(f"{name}{k} as (select g, n, idx // 16 as idx, sha256(string_agg(d, '' order by idx)) as d, list(d order by idx) as kids"
                     f" from {previous} where n > {16 ** (k - 1)} group by g, n, idx // 16)")
        roots.append(f"select g, d from {name}{k} where n > {16 ** (k - 1)} and n <= {16 ** k}")
        previous = f"{name}{k}"
    return ",\n        ".join(parts) + f",\n        {name}_roots as ({' union all '.join(roots)})"


def _fold(name: str, tree: str, rows: str, levels: int) -> str:
    """CTEs that lead ``rows`` (id, g, idx, cur, proof) up through the tree."""
    parts, previous = [], rows
    left = "coalesce(array_to_string(t.kids[1:r.idx % 16], ''), '')"
    right = "coalesce(array_to_string(t.kids[r.idx % 16 + 2:], ''), '')"
    for k in range(1, levels + 1):
        parts.append(f"{name}{k} as (select r.id, r.g, r.idx // 16 as idx, case when t.kids is null then r.cur else sha256({left} || r.cur || {right}) end as cur,"
                     f" r.proof || {left} || {right} as proof from {previous} r left join {tree}{k} t on t.g is not distinct from r.g and t.idx = r.idx // 16)")
        previous = f"{name}{k}"
    return ",\n        ".join(parts)


def _leaf(text: str) -> str:
    fields = ["cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CRC = """xor(list_reduce(list_prepend(4294967295::bigint, [ascii(x)::bigint for x in string_split(cast(doc_id as varchar), '')]),
                 lambda c, b: list_reduce(list_prepend(xor(c, b), [i::bigint for i in range(8)]),
                                          lambda x, i: xor(x >> 1, 3988292384::bigint * (x & 1)))), 4294967295::bigint)"""

MERKLE_SQL = f"""
    with l as (
            select row_number() over () as id, doc_id, source as g, {_leaf('text')} as d, case when ({CRC}) % 5 = 0 then {_leaf(LOWERED)} end as other from documents),
        leaves as (
            select id, doc_id, g, d, coalesce(other, d) as cur, count(*) over (partition by g) as n,
                   row_number() over (partition by g order by doc_id nulls first, d, id) - 1 as idx from l),
        {_tree('t', 'leaves', LEVELS)},
        sources as (select 0 as g, count(*) over () as n, row_number() over (order by g nulls first) - 1 as idx, d, g as source from t_roots),
        {_tree('s', 'sources', TOP_LEVELS)},
        start as (select id, g, idx, cur, '' as proof from leaves),
        {_fold('f', 't', 'start', LEVELS)},
        middle as (select f.id, 0 as g, s.idx, f.cur, f.proof from f{LEVELS} f join sources s on s.source is not distinct from f.g),
        {_fold('h', 's', 'middle', TOP_LEVELS)}
    select doc_id, l.d as leaf, r.d as subroot, root.d as root, sha256(h.proof) as proof_sha256, h.cur as folded_root, h.cur = root.d as verified
    from leaves l join h{TOP_LEVELS} h on h.id = l.id join t_roots r on r.g is not distinct from l.g cross join s_roots root"""

_CONTROLS = "([<\\[])(\\\\*)(s>|/s>|INST\\]|/INST\\]|SYS\\]|/SYS\\]|ROLE\\]|TEXT\\]|/TEXT\\])"
_ESCAPED = "length(regexp_replace({}, '" + _CONTROLS + "', '\\1\\\\\\2\\3', 'g'))"

CHAT_SQL = f"""
    with t as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    sized as (
        select *, sha256(text) as tie, {_ESCAPED.format('text')} + case role when 'user' then 15 when 'assistant' then 5 when 'system' then 13
                  else 23 + {_ESCAPED.format('role')} end as chars from t),
    said as (
        select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, tie) as turns,
               coalesce(string_agg(text, '' order by turn nulls first, role, tie) filter (role = 'assistant'), '') as loss, 3 + sum(chars) as formatted_chars
        from sized group by conv_id)
    select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256,
           formatted_chars::bigint as formatted_chars from said"""
