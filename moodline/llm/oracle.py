"""DuckDB SQL for the operators that SQL can express: sharding, licence scans, exact top-k.

The others train models, sample, sketch or tokenise; tests hold them against
brute force instead.
"""

from __future__ import annotations

import re

from moodline.llm import collocations, license_scan, line_quality, shard_table


def op3_shards() -> str:
    table = ",".join(str(s) for s in shard_table.filled(shard_table.SHARDS))
    return f"""
    with t as (select [{table}] as shards),
    k as (select doc_id, ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint
                 % {shard_table.PRIME} as slot from documents)
    select doc_id, slot, 'shard-' || lpad(cast(shards[slot + 1] as varchar), 3, '0') as shard from k, t"""


def _as_regex(template: str) -> str:
    """A template over words that each stand after one space, with a space at the end of the text."""
    out = ""
    for token in re.findall(r"\[\[|\]\]|\{\{\w+:\d+\}\}|[^\s\[\]{}]+", template):
        if token == "[[":
            out += "(?:"
        elif token == "]]":
            out += ")?"
        elif token.startswith("{{"):
            out += f"(?: [^ ]+){{0,{token.strip('{}').split(':')[1]}}}"
        else:
            out += " " + token
    return out + " "


def op5_licenses() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    starts, labels = [], []
    for phrase, label in license_scan.BASE.items():
        ws = phrase.split()
        same = " and ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(ws))
        starts.append(f"list_filter(range(1, len(w) - {len(ws) - 2}), lambda i: {same})")
        labels.append((f"contains(j, ' {phrase} ')", label, True))
    for label, template in license_scan.TEMPLATES.items():
        labels.append((f"regexp_matches(j, '{_as_regex(template)}')", label, False))
    base = ", ".join(f"case when {test} then '{label}' end" for test, label, own in labels if own)
    every = ", ".join(f"case when {test} then '{label}' end" for test, label, _ in labels)
    more = " or ".join(test for test, _, own in labels if not own)

    def joined(items: str) -> str:
        return f"array_to_string(list_sort(list_filter([{items}], lambda x: x is not null)), ',')"

    return f"""
    with words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
    found as (select doc_id, w, ' ' || array_to_string(w, ' ') || ' ' as j, flatten([{', '.join(starts)}]) as s from words)
    select doc_id, cast(len(w) as bigint) as n_words, cast(len(s) as bigint) as n_base,
           cast(list_min(s) - 1 as bigint) as first_word, cast(list_max(s) - 1 as bigint) as last_word,
           {joined(base)} as base_labels, {joined(every)} as labels,
           case when {more} then 1.0::double when len(s) > 0 then 0.5::double else 0.0::double end as score
    from found"""


def op6_topk() -> str:
    return """
    with v as (select distinct vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
               from embeddings
               where vec_id is not null and len(embedding) > 0
                 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
          from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
    select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5"""


def op11_quality() -> str:
    space, word = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0000000000"
    own = line_quality
    return f"""
    with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t,
                      regexp_extract_all(coalesce(text, ''), '{space}') as w from documents),
    win as (select r, i, w[i:i + {own.WINDOW - 1}] as x from (select r, w, unnest(range(1, len(w) - {own.WINDOW - 2})) as i from d)),
    twice as (select r, i from (select *, count(*) over (partition by r, x) as n from win) where n > 1),
    rep as (select r, count(distinct p) as n from (select r, unnest(range(i, i + {own.WINDOW})) as p from twice) group by r),
    lines as (select r, source, t, line, len(regexp_extract_all(line, '{space}')) as n,
                     array_to_string(regexp_extract_all(translate(line, '{upper}', '{lower}'), '{word}'), ' ') as form
              from (select r, source, t, unnest(string_split(t, chr(10))) as line from d)),
    dup as (select r, count(*) - count(distinct line) as n from lines where n > 0 group by r),
    held as (select source, form, count(distinct t) as n from lines where form <> '' group by source, form),
    hosts as (select source, count(distinct t) as n from d group by source),
    high as (select h.source, h.form from held h join hosts s on h.source is not distinct from s.source
             where h.n >= {own.LEAST_DOCUMENTS} and h.n > {own.SHARE}::double * s.n),
    cut as (select l.r, count(distinct l.form) as lines, sum(l.n) as words from lines l
            join high f on l.form = f.form and l.source is not distinct from f.source group by l.r),
    base as (select d.r, doc_id, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
                    len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(dup.n, 0) as n_dup_lines,
                    coalesce(rep.n, 0) as n_repeat_words, coalesce(cut.lines, 0) as n_removed_lines,
                    coalesce(cut.words, 0) as n_removed_words
             from d left join rep using (r) left join dup using (r) left join cut using (r)),
    failed as (select *, n_words < {own.LEAST_WORDS} or 100 * n_repeat_words > {round(100 * own.MOST_REPEATED)} * n_words
               as base_failed from base)
    select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
           cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
           cast(n_repeat_words as bigint) as n_repeat_words, base_failed, cast(n_removed_lines as bigint) as n_removed_lines,
           cast(n_removed_words as bigint) as n_removed_words,
           not (base_failed or n_words - n_removed_words < {own.LEAST_LEFT}::double * n_words) as kept
    from failed"""


def op12_manifest() -> str:
    def leaf(n_chars: str) -> str:
        values = ["doc_id::varchar", "source", "lang", f"({n_chars})::varchar", "text"]
        return "sha256(" + " || ".join(f"coalesce(strlen({v})::varchar || ':' || {v}, '-')" for v in values) + ")"

    def tree(name: str, leaves: str) -> str:
        return f"""{name}(g, lvl, idx, digest, n) as (
            select g, 0::bigint, idx, digest, n from {leaves}
            union all
            select g, lvl + 1, idx // 2, sha256(string_agg(digest, '' order by idx)), (n + 1) // 2
            from {name} where n > 1 group by g, lvl, idx // 2, n),
        {name}_steps as (select a.g, a.lvl, a.idx, b.digest as sib, b.idx < a.idx as to_left
            from {name} a left join {name} b on a.g = b.g and a.lvl = b.lvl and b.idx = xor(a.idx, 1) where a.n > 1)"""

    # DuckDB has no CRC-32: a table of its 256 entries, by rule
    crc = []
    for k in range(256):
        for _ in range(8):
            k = k >> 1 ^ 0xEDB88320 * (k & 1)
        crc.append(k)
    table = ",".join(map(str, crc))
    return f"""
    with recursive crc_of(id, rest, c) as (
        select distinct doc_id, doc_id::varchar, 4294967295::bigint from documents where doc_id is not null
        union all
        select id, substr(rest, 2), xor(c >> 8, ([{table}]::bigint[])[(xor(c, ord(rest)::bigint) & 255) + 1]) from crc_of where rest <> ''),
    told as (select id, xor(c, 4294967295::bigint) % 7 = 0 as hit from crc_of where rest = ''),
    d as (select row_number() over () as r, doc_id, coalesce('=' || lang, '') as g, {leaf("n_chars")} as digest,
                 case when coalesce(hit, false) then {leaf("n_chars::hugeint + 1")} else {leaf("n_chars")} end as seen
          from documents left join told on doc_id = id),
    leaves as (select *, row_number() over (partition by g order by doc_id nulls first, digest) - 1 as idx,
                      count(*) over (partition by g) as n from d),
    {tree("own", "leaves")},
    tops as (select '' as g, g as grp, digest, lvl as depth, row_number() over (order by g) - 1 as idx, count(*) over () as n
             from own where n = 1),
    {tree("high", "tops")},
    steps as (select l.r, s.lvl as step, s.sib, s.to_left from leaves l join own_steps s on l.g = s.g and s.idx = l.idx >> s.lvl
              union all
              select l.r, t.depth + s.lvl, s.sib, s.to_left from leaves l join tops t on l.g = t.grp
              join high_steps s on s.idx = t.idx >> s.lvl),
    proofs as (select r, count(*) as n, sha256(coalesce(string_agg(sib, '' order by step), '')) as proof_sha256 from steps group by r),
    fold(r, step, digest) as (
        select r, 0::bigint, seen from leaves
        union all
        select f.r, f.step + 1, sha256(case when s.sib is null then f.digest when s.to_left then s.sib || f.digest
                                       else f.digest || s.sib end)
        from fold f join steps s on s.r = f.r and s.step = f.step),
    ends as (select l.r, l.doc_id, nullif(l.g, '') as g, l.digest as leaf, t.digest as subroot,
                    (select digest from high where n = 1) as root, coalesce(p.proof_sha256, sha256('')) as proof_sha256,
                    f.digest as folded_root
             from leaves l join tops t on l.g = t.grp left join proofs p on p.r = l.r
             join fold f on f.r = l.r and f.step = coalesce(p.n, 0))
    select doc_id, substr(g, 2) as lang, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from ends"""


def op13_collocations() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    own = collocations
    grams = " union all ".join(
        f"select lang, {k} as len, w[i:i + {k - 1}] as p from (select lang, w, unnest(range(1, len(w) - {k - 2})) as i from pieces)"
        for k in range(1, own.LONGEST + 1))
    return f"""
    with pieces as (
        select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w
        from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                  translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents)),
    f as (select lang, len, p, count(*)::hugeint as n from ({grams}) group by lang, len, p),
    total as (select lang, sum(n)::bigint as n from f where len = 1 group by lang),
    c as (select *, row_number() over () as c from f where len > 1 and n >= {own.LEAST}),
    cuts as (select c.c, k, l.n as l, r.n as r, {own.SCALE} * c.n // (l.n + r.n) as score
             from (select *, unnest(range(1, len)) as k from c) c
             join f l on l.lang = c.lang and l.p = c.p[1:k] join f r on r.lang = c.lang and r.p = c.p[k + 1:c.len]),
    low as (select * from cuts qualify row_number() over (partition by c order by score, k) = 1),
    parts as (select lang, n, p[i:j] as p from (
                  select lang, n, p, len, i, unnest(range(i + 1, len + 1)) as j from (
                      select lang, n, p, len, unnest(range(1, len)) as i from c)) where j - i + 1 < len),
    over as (select lang, p, max(n) as n from parts group by lang, p),
    kept as (select c.lang, array_to_string(c.p, ' ') as phrase, c.n as a, low.l, low.r, low.score
             from c join low using (c) left join over o on o.lang = c.lang and o.p = c.p
             where o.n is null or 100 * o.n < 80 * c.n),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
    select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, total.n, score::bigint as score
    from ranked join total using (lang) where rank <= {own.TOP}"""


def oracle_sql() -> dict[str, str]:
    return {fn.__name__: fn() for fn in (op3_shards, op5_licenses, op6_topk, op11_quality, op12_manifest,
                                        op13_collocations)}
