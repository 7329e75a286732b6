"""DuckDB SQL for the corpus queries that SQL can express; the others are
tested against brute force in ``tests/llm``."""

SQL = {
    # lower() is told to touch A-Z only by translate()
    "op5_exact_dedup": """
        with t as (
            select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) as text_sha256
            from documents),
        g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size
              from t group by text_sha256)
        select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, t.text_sha256
        from t join g using (text_sha256)""",
    # a window is named by its words; a word goes when a window over it starts in a smaller document
    "op6_subtree_dedup": r"""
        with docs as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
        word as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as j from docs),
        windows as (
            select doc_id, i, array_to_string(ws[i:i + 12], ' ') as k
            from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from docs where len(ws) > 12)),
        first as (select k, min(doc_id) as least from windows group by k),
        gone as (
            select distinct doc_id, i + unnest(range(0, 13)) as j
            from windows join first using (k) where least < doc_id),
        kept as (
            select doc_id, string_agg(w, ' ' order by j) as t, count(*) as n
            from word anti join gone using (doc_id, j) group by doc_id)
        select d.doc_id, len(d.ws) as n_words, len(d.ws) - coalesce(n, 0) as n_removed,
               sha256(coalesce(t, '')) as kept_sha256
        from docs d left join kept using (doc_id)""",
    "op11_url_rules": """
        with u as (
            select row_number() over () as rid, page_id,
                   case when url like '%://%' then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages),
        h as (
            select rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
            from u),
        rules(rhost, rpath, verdict) as (
            values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                   ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        fits as (
            select rid, rhost || rpath as rule, verdict,
                   row_number() over (partition by rid order by length(rhost || rpath) desc) as place
            from h join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
        from h left join (select * from fits where place = 1) f on h.rid = f.rid""",
    "op12_fill_in_middle": r"""
        with t as (
            select doc_id, coalesce(text, '') as text, sha256('1:' || doc_id) as sha,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as ws
            from documents),
        drawn as (
            select *, [('0x' || substr(sha, 1, 8))::bigint, ('0x' || substr(sha, 9, 8))::bigint,
                       ('0x' || substr(sha, 17, 8))::bigint, ('0x' || substr(sha, 25, 8))::bigint] as h
            from t),
        cuts as (
            select *, least(h[1] % (len(ws) + 1), h[2] % (len(ws) + 1)) as a,
                   greatest(h[1] % (len(ws) + 1), h[2] % (len(ws) + 1)) as b,
                   case when text = '' or text like '%<P>%' or text like '%<S>%' or text like '%<M>%'
                             or h[3] % 100 >= 90 then 'plain'
                        when h[4] % 100 < 20 then 'spm' else 'psm' end as form
            from drawn),
        pieces as (
            select *, array_to_string(ws[1:a], '') as p, array_to_string(ws[a + 1:b], '') as m,
                   array_to_string(ws[b + 1:], '') as s
            from cuts)
        select doc_id, len(ws) as n, form,
               case when form <> 'plain' then length(p) end as prefix_chars,
               case when form <> 'plain' then length(m) end as middle_chars,
               sha256(case form when 'plain' then text
                      when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                      else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
               sha256(text) as restored_sha256
        from pieces""",
    "op13_source_divergence": r"""
        with d as (
            select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as ws
            from documents),
        per_doc as (
            select rid, lang, source, term, count(*) as n
            from (select rid, lang, source, unnest(ws) as term from d) group by all),
        kept as (select lang, term from per_doc group by lang, term having count(*) >= 30),
        groups as (select distinct lang, source from d),
        sizes as (
            select g.lang, coalesce(k.v, 0) as v
            from (select distinct lang from groups) g
            left join (select lang, count(*) as v from kept group by lang) k on g.lang = k.lang),
        seen as (select lang, source, term, sum(n) as n from per_doc join kept using (lang, term) group by all),
        every as (
            select g.lang, g.source, k.term, coalesce(s.n, 0)::hugeint as n
            from groups g join kept k on g.lang = k.lang
            left join seen s on s.lang = g.lang and s.source = g.source and s.term = k.term),
        shares as (
            select lang, source, term, n,
                   1 + (1000000000::hugeint * (n + 5))
                       // (sum(n) over (partition by lang, source) + 5 * count(*) over (partition by lang, source))
                       as p
            from every),
        all_seen as (select lang, term, sum(n)::hugeint as n from every group by all),
        whole as (
            select lang, term, 1 + (1000000000::hugeint * (n + 5))
                       // (sum(n) over (partition by lang) + 5 * count(*) over (partition by lang)) as q
            from all_seen),
        sums as (
            select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
            from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
            group by all),
        pairs as (
            select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
            from groups a join groups b on a.lang = b.lang and a.source <> b.source
            left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
        terms as (
            select lang, source, 'term' as part, term as item, p - q as value
            from shares join whole using (lang, term) where n > 0 and p > q),
        ranked as (
            select *, row_number() over (partition by lang, source, part order by value desc, item) as place
            from (select * from pairs union all select * from terms))
        select lang, source, part, item, value::bigint as value, place::int as rank
        from ranked where part = 'pair' or place <= 50""",
}
