"""DuckDB SQL of the operators that SQL can express; the given tables are views."""

from __future__ import annotations

# CRC-32 of a list of bytes: a table of 256 entries from the polynomial, then one look-up a byte.
_CRC_TABLE = """crc_table as (select list(v order by i) as t from (select i,
    list_reduce(list_concat([i], range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from (select unnest(range(256)) as i)))"""


def _crc32(codes: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8)), 4294967295)"


_DIGITS = _crc32("list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ord(x) as bigint))")


def _field(column: str) -> str:
    text = f"cast({column} as varchar)"
    return f"coalesce(cast(strlen({text}) as varchar) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _tree(name: str, base: str) -> str:
    """Nodes of binary trees over ``base`` (tree, idx, digest), and the steps of each leaf: the
    sibling's digest behind L or R for its side, or N where there is none."""
    return f"""{name}_nodes as (
      select tree, 0 as level, idx, digest, count(*) over (partition by tree) as n from {base}
      union all
      select tree, level + 1, idx // 2, sha256(string_agg(digest, '' order by idx)), (n + 1) // 2
      from {name}_nodes where n > 1 group by tree, level, idx // 2, n),
    {name}_steps as (
      select b.tree, b.idx, coalesce(list(case when s.digest is null then 'N' when s.idx < (b.idx >> p.level) then 'L' || s.digest
          else 'R' || s.digest end order by p.level) filter (where p.level is not null), []) as steps
      from {base} b left join (select distinct tree, level from {name}_nodes where n > 1) p on b.tree = p.tree
        left join {name}_nodes s on s.tree = b.tree and s.level = p.level and s.idx = xor(b.idx >> p.level, 1)
      group by b.tree, b.idx)"""


MERKLE = f"""with recursive {_CRC_TABLE},
    leaves as (
      select doc_id, coalesce('=' || lang, '') as tree, {_leaf('n_chars')} as digest,
        case when {_DIGITS} % 7 = 0 and n_chars is not null then {_leaf('(n_chars + 1)')} else {_leaf('n_chars')} end as claimed
      from documents, crc_table),
    placed as (select *, row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as idx from leaves),
    {_tree('own', 'placed')},
    tops as (select tree as name, digest, '' as tree, row_number() over (order by tree) - 1 as idx
      from own_nodes where n = 1),
    {_tree('top', 'tops')}
  select p.doc_id, p.digest as leaf, t.digest as subroot, r.digest as root,
    sha256(coalesce(list_aggregate(list_transform(list_concat(s.steps, u.steps), lambda x: x[2:]), 'string_agg', ''), '')) as proof_sha256,
    list_reduce(list_concat([p.claimed], s.steps, u.steps), lambda a, x: sha256(case x[1] when 'L' then x[2:] || a when 'R' then a || x[2:] else a end))
      as folded_root,
    folded_root = root as verified
  from placed p join own_steps s on p.tree = s.tree and p.idx = s.idx join tops t on t.name = p.tree
    join top_steps u on u.idx = t.idx cross join (select digest from top_nodes where n = 1) r"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BYTES = "list_transform(range(0, strlen(word)), lambda i: cast('0x' || substr(hex(word), cast(2 * i + 1 as bigint), 2) as bigint))"

IMPORTANCE = f"""with {_CRC_TABLE},
    own as (select doc_id, {_WORDS} as words from documents),
    words as (select doc_id, unnest(words) as word from own),
    target as (select unnest({_WORDS}) as word from benchmark),
    known as (select word, {_crc32(_BYTES)} % 10000 as bucket from (select word from words union select word from target), crc_table),
    have as (select bucket, count(*) as s from words join known using (word) group by 1),
    want as (select bucket, count(*) as t from target join known using (word) group by 1),
    gains as (select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from words) + 10000)::double
        / ((coalesce(s, 0) + 1)::double * ((select count(*) from target) + 10000)::double))) as bigint) as gain
      from (select distinct bucket from known) left join have using (bucket) left join want using (bucket)),
    weighed as (select doc_id, count(*) as n_features, cast(sum(gain) as bigint) as weight
      from words join known using (word) join gains using (bucket) group by 1),
    scored as (select o.doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || sha256('2024:' || o.doc_id)[:8] as bigint) + 0.5::double) / 4294967296::double))) as bigint) as score
      from own o left join weighed w on o.doc_id = w.doc_id),
    able as (select doc_id, row_number() over (order by score desc, doc_id) as place, 10 * count(*) over () // 100 as take
      from scored where n_features >= 20)
  select s.doc_id, n_features, weight, score, case when place <= take then place end as rank
  from scored s left join able a on s.doc_id = a.doc_id"""



def _closure(edges: str) -> str:
    """(node, component): the smallest node that each node reaches over both directions of ``edges``."""
    return f"""reach as (select a as node, b as other from {edges} union select b, a from {edges}
      union select r.node, e.other from reach r join (select a as node, b as other from {edges} union select b, a from {edges}) e on r.other = e.node),
    component as (select node, least(node, min(other)) as component from reach group by node)"""


_PARTS = r"regexp_extract_all(" + _LOWER + r", '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = f"""with recursive
    own as (select doc_id, {_PARTS} as words from documents),
    shingles as (select distinct doc_id, array_to_string(words[i : i + 3], ' ') as shingle
      from (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) as i from own where len(words) > 0)),
    sizes as (select doc_id, count(*) as n from shingles group by 1),
    links as (select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
      join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
      group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    {_closure('links')}
  select o.doc_id, coalesce(n, 0) as n_shingles, coalesce(component, o.doc_id) as component_id, coalesce(component, o.doc_id) = o.doc_id as kept
  from own o left join sizes s on o.doc_id = s.doc_id left join component c on o.doc_id = c.node"""

NEAR_VECTORS = f"""with recursive
    fine as (select vec_id, label, v from (select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings)
      where label is not null and v is not null and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(v, lambda x: x <> 0)) > 0),
    links as (select x.vec_id as a, y.vec_id as b from fine x join fine y
      on x.label = y.label and x.vec_id < y.vec_id and len(x.v) = len(y.v)
      where list_dot_product(x.v, y.v) / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))) >= 0.98),
    {_closure('links')}
  select e.vec_id, coalesce(n, 0) as n_links, coalesce(component, e.vec_id) as component_id, coalesce(component, e.vec_id) = e.vec_id as kept
  from embeddings e left join component c on e.vec_id = c.node
    left join (select node, count(*) as n from (select a as node from links union all select b from links) group by 1) k on e.vec_id = k.node"""

# A digest's 160 bits as 32 letters of five bits: two hex digits hold each of them.
_BASE32 = """list_aggregate(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[cast(1 +
  ((cast('0x' || substr(sha1(payload), cast(5 * i // 4 + 1 as bigint), 2) as bigint) >> (3 - 5 * i % 4)) & 31) as bigint)]), 'string_agg', '')"""

ARCHIVE = f"""select page_id, strlen(payload) as payload_bytes, {_BASE32} as payload_digest,
    case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id <> last then last end as refers_to,
    true as verified
  from (select page_id, payload, max(page_id) over (partition by payload) as last from (select page_id, coalesce(html, '') as payload from pages))"""

# Windows are cut from blocks of a thousand bytes, so that no long text is gone through from its start each time.
SUFFIXES = """with own as (select doc_id, lower(hex(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
    blocks as (select doc_id, k * 1000 as base, substr(h, cast(k * 2000 + 1 as bigint), 2098) as part
      from (select *, unnest(range(0, n // 1000 + 1)) as k from own)),
    windows as (select doc_id, base + i as pos, substr(part, cast(2 * i + 1 as bigint), 100) as w
      from (select *, unnest(range(0, least(1000, len(part) // 2 - 49))) as i from blocks)),
    lowest_of as (select w, min(doc_id) as lowest, max(doc_id) as most from windows group by 1 having min(doc_id) < max(doc_id)),
    gone as (select doc_id, pos from windows join lowest_of using (w) where lowest < doc_id),
    runs as (select doc_id, min(pos) as a, max(pos) + 50 as b from (select doc_id, pos, sum(jump) over (partition by doc_id order by pos) as run
      from (select doc_id, pos, case when pos - lag(pos) over (partition by doc_id order by pos) <= 50 then 0 else 1 end as jump from gone)) group by doc_id, run),
    kept as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as a, a as b from runs
      union all select o.doc_id, coalesce(max(r.b), 0), any_value(o.n) from own o left join runs r on o.doc_id = r.doc_id group by o.doc_id),
    rest as (select k.doc_id, coalesce(string_agg(substr(h, cast(2 * k.a + 1 as bigint), cast(2 * (k.b - k.a) as bigint)), '' order by k.a), '') as h
      from kept k join own o on k.doc_id = o.doc_id group by k.doc_id),
    sums as (select doc_id, cast(sum(b - a) as bigint) as removed, count(*) as spans from runs group by 1)
  select o.doc_id, o.n as n_bytes, coalesce(removed, 0) as n_removed, coalesce(spans, 0) as n_spans, sha256(unhex(r.h)) as kept_sha256
  from own o join rest r on o.doc_id = r.doc_id left join sums s on o.doc_id = s.doc_id"""

ORACLES: dict[str, str] = {
    "op5_cover_tree": NEAR_VECTORS,
    "op9_lsh_forest": NEAR_DUPLICATES,
    "op10_warc": ARCHIVE,
    "op11_suffix_dedup": SUFFIXES,
    "op12_importance": IMPORTANCE,
    "op13_merkle": MERKLE,
}
