"""SQL of the corpus queries that DuckDB can express."""

from __future__ import annotations

ORACLES = {
    "op11_prefix_trie": """
        with recursive
        words as (select list(crc order by i) as words from (
            select i, list_reduce(list_prepend(i::bigint, range(8)), lambda c, _: case when c & 1 = 1
                then xor(c >> 1, 3988292384) else c >> 1 end) as crc from range(256) t(i))),
        turns as (
            select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first,
                sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as turns
            from conversations where conv_id is not null group by conv_id),
        heads as (
            select conv_id, turns, xor(list_reduce(list_prepend(4294967295::bigint,
                list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
                lambda c, b: xor(c >> 8, words[(xor(c, b) & 255) + 1])), 4294967295) % 9 as h
            from turns, words),
        rebuilt as (
            select a.conv_id, coalesce(b.turns[1:a.h], []) || a.turns[a.h + 1:] as turns
            from heads a left join turns b on b.conv_id = a.conv_id - a.conv_id % 5),
        members as (
            select conv_id, depth, min(conv_id) over (partition by depth, turns[1:depth]) as node, len(turns) = depth as ended,
                case when depth > 0 then strlen(turns[depth].t) else 0 end as bytes
            from (select conv_id, turns, unnest(range(len(turns) + 1)) as depth from rebuilt)),
        nodes as (
            select depth, node, count(*) as n_convs, any_value(bytes) as bytes,
                sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256
            from members group by depth, node),
        placed as (
            select n.*, p.node as parent from nodes n
            left join members p on p.conv_id = n.node and p.depth = n.depth - 1),
        children as (select depth - 1 as depth, parent as node, count(*) as n from placed where depth > 0 group by 1, 2),
        counted as (select p.*, coalesce(c.n, 0) as n_children from placed p left join children c using (depth, node)),
        below as (
            select m.depth, m.node, sum((c.n_convs - 1) * c.bytes)::bigint as saved_tokens,
                count(*) filter (c.n_children = 0) as n_leaves
            from counted c join members m on m.conv_id = c.node and m.depth <= c.depth group by m.depth, m.node)
        select node as conv_id, depth, parent as parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        from counted join below using (depth, node)""",
    "op12_hard_negatives": """
        with whole as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
            from embeddings where vec_id is not null and label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
                list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint as score
            from whole a join whole b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
        positives as (
            select anchor_id, other_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
        select anchor_id, positive_id, (row_number() over pairs)::int as rank, other_id as negative_id, positive_score, score as negative_score
        from positives join scored using (anchor_id)
        where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
        window pairs as (partition by anchor_id, positive_id order by score desc, other_id)
        qualify row_number() over pairs <= 10""",
    "op13_warc": """
        with digits as (
            select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as sha from pages),
        coded as (
            select page_id, payload, array_to_string(list_transform(range(32), lambda i:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    ((('0x' || substr(sha, ((i // 4) * 5 + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int + 1, 1)), '') as payload_digest
            from digits)
        select page_id, strlen(payload) as payload_bytes, payload_digest,
            case when page_id = min(page_id) over same then 'response' else 'revisit' end as record_type,
            case when page_id = min(page_id) over same then null else min(page_id) over same end as refers_to
        from coded window same as (partition by payload)""",
}
