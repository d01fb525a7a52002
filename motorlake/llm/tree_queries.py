"""Queries of the operators on trees and bins, with their SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from motorlake.llm import merkle, packing, trie
from motorlake.llm.common import table
from motorlake.llm.registry import query

# DuckDB has no crc32: its table of bytes by the polynomial's rule, then one step per byte.
_CRC_TABLE = """
    crc_bits(i, v, k) as (
      select i, i, 0 from range(256) t(i)
      union all
      select i, case when (v & 1) = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from crc_bits where k < 8),
    crc_table as (select list(v order by i) as crc from crc_bits where k = 8)"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda c: cast(ascii(c) as bigint))"
    step = "lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {codes}), {step}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = [f"cast({c} as varchar)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(map(_field, fields)) + ")"


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _nodes(name: str, entries: str) -> str:
    return f"""
    {name}(tree, lvl, pos, n, digest) as (
      select tree, 0, pos, n, digest from {entries}
      union all
      select tree, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by pos))
      from {name} where n > 1 group by tree, lvl, n, pos // 8),
    {name}_runs as (
      select tree, lvl, pos // 8 as parent, list(digest order by pos) as run
      from {name} where n > 1 group by tree, lvl, pos // 8)"""


def _folds(name: str, nodes: str, start: str) -> str:
    others = "array_to_string(run[1 : pos % 8] || run[pos % 8 + 2 :], '')"
    return f"""
    {name}(id, tree, lvl, pos, digest, siblings) as (
      {start}
      union all
      select id, f.tree, f.lvl + 1, pos // 8,
        sha256(array_to_string(run[1 : pos % 8] || [digest] || run[pos % 8 + 2 :], '')), siblings || {others}
      from {name} f join {nodes}_runs r on f.tree = r.tree and f.lvl = r.lvl and pos // 8 = r.parent)"""


@query(
    "op11_merkle_manifest",
    oracle=f"""
    with recursive {_CRC_TABLE},
    hashed as (
      select doc_id, lang, {_leaf('text')} as digest,
        case when {_crc32("cast(doc_id as varchar)")} % 3 = 0
          then {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} else {_leaf('text')} end as changed
      from documents, crc_table),
    leaves as (
      select *, row_number() over () as id, dense_rank() over (order by lang nulls first) - 1 as tree,
        row_number() over (partition by lang order by doc_id nulls first, digest) - 1 as pos,
        count(*) over (partition by lang) as n
      from hashed),
    {_nodes('nodes', 'leaves')},
    tops as (
      select 0 as tree, tree as pos, count(*) over () as n, digest from nodes where n = 1),
    {_nodes('upper', 'tops')},
    {_folds('inner_folds', 'nodes', "select id, tree, 0, pos, changed, '' from leaves")},
    reached as (
      select id, tree, digest, siblings from inner_folds
      qualify row_number() over (partition by id order by lvl desc) = 1),
    {_folds('outer_folds', 'upper', "select id, 0, 0, tree, digest, siblings from reached")},
    ended as (
      select id, digest, siblings from outer_folds
      qualify row_number() over (partition by id order by lvl desc) = 1)
    select doc_id, leaves.digest as leaf, tops.digest as subroot, root.digest as root,
      sha256(siblings) as proof_sha256, ended.digest as folded_root, ended.digest = root.digest as verified
    from leaves join ended using (id) join tops on leaves.tree = tops.pos
      join (select digest from upper where n = 1) root on true
    """,
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query(
    "op12_prefix_trie",
    oracle=f"""
    with recursive {_CRC_TABLE},
    said as (
      select conv_id, turn, strlen(coalesce(text, '')) as bytes,
        left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) as id
      from conversations where conv_id is not null),
    turns as (
      select *, row_number() over (partition by conv_id order by turn nulls first, id) - 1 as i from said),
    owned as (select conv_id, count(*) as n from turns group by conv_id),
    convs as (
      select conv_id, n, conv_id - conv_id % 5 as base, {_crc32("cast(conv_id as varchar)")} % 9 as h
      from owned, crc_table),
    rebuilt as (
      select c.conv_id, i + 1 as d, id, bytes from convs c join turns t on t.conv_id = c.base and i < h
      union all
      select c.conv_id, least(h, coalesce(o.n, 0)) + i - h + 1, id, bytes
      from convs c join turns t on t.conv_id = c.conv_id and i >= h left join owned o on o.conv_id = c.base),
    whole as (
      select c.conv_id, list(id order by d) filter (d is not null) as ids, count(d) as len
      from convs c left join rebuilt r on c.conv_id = r.conv_id group by c.conv_id),
    deep as (select conv_id, ids, len, unnest(range(0, len + 1)) as d from whole),
    prefixes as (
      select p.conv_id, p.d, len, coalesce(array_to_string(ids[1 : p.d], ''), '') as k, coalesce(bytes, 0) as bytes
      from deep p left join rebuilt r on p.conv_id = r.conv_id and p.d = r.d),
    nodes as (
      select d, k, min(conv_id) as conv_id, count(*) as n, max(bytes) as bytes, max(len) = d as childless,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len = d), '')) as ends_sha256
      from prefixes group by d, k),
    below as (
      select p.d, p.k, sum((a.n - 1) * a.bytes) as saved_tokens, count(*) filter (a.childless) as n_leaves,
        count(*) filter (a.d = p.d + 1) as n_children
      from nodes a join prefixes p on p.conv_id = a.conv_id and p.d <= a.d group by p.d, p.k)
    select nodes.conv_id, nodes.d as depth, parent.conv_id as parent_conv_id, nodes.n as n_convs,
      cast(n_children as bigint) as n_children, cast(n_leaves as bigint) as n_leaves,
      cast(saved_tokens as bigint) as saved_tokens, nodes.ends_sha256
    from nodes join below using (d, k)
      left join prefixes up on up.conv_id = nodes.conv_id and up.d = nodes.d - 1
      left join nodes parent on parent.d = up.d and parent.k = up.k
    """,
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("row_id", "ids")
