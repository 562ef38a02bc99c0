"""DuckDB oracles of the clustering operators: all pairs and recursive closure, feasible at test size only."""

from __future__ import annotations

from adgrove.functions.distance import STOP_HOSTS
from workload import views as v

EPS, MIN_POINTS = 0.1, 3
VECTOR_EPS, VECTOR_MIN = 11300, 3
ASSIGN_EPS = 0.12
MIXED_EPS, USER, COMPANY, CITY = 0.1, 0.02, 0.01, 0.02


def hash_d(a: str, b: str) -> str:
    return f"bit_count(xor({a}, {b})) / length(bin(xor({a}, {b})))"


def hash_adjacency(eps: float) -> str:
    return f"""adj as materialized (select * from (select a.part, a.idx as i, b.idx as j, {hash_d('a.hash', 'b.hash')} as d
    from pts a join pts b on a.part = b.part and a.idx <> b.idx) q where d < {eps}::double)"""


SQUARED = "cast(list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(a.vector, b.vector)]) as bigint)"


def vector_adjacency(eps: int) -> str:
    return f"""adj as materialized (select * from (select a.part, a.idx as i, b.idx as j, {SQUARED} as d
    from pts a join pts b on a.idx <> b.idx) q where d < {eps}::bigint * {eps})"""


#: Noise points by index, each at the end of its chain of nearest neighbours.
NOISE_CHAINS = """nearest as (select i, j from (select i, j, row_number() over (partition by i order by d, j) as rn from adj) r where rn = 1),
    ptr as materialized (select p.idx, p.part, case when n.j in (select idx from placed) or n.j < p.idx then n.j else p.idx end as t
      from pts p left join nearest n on n.i = p.idx where p.idx not in (select idx from placed)),
    chain(idx, part, t) as (select idx, part, t from ptr
      union select chain.idx, chain.part, ptr.t from chain join ptr on ptr.idx = chain.t where ptr.t <> chain.t),
    fin as materialized (select * from chain where t in (select idx from placed) or t in (select idx from ptr where idx = t))"""


def dbscan_ctes(points: str, adjacency: str, min_points: int, noise: str = "singleton", start: int = 1) -> str:
    """CTEs ending in ``labelled(part, idx, cluster_id, met)``; ``met`` marks points counted as noise when visited."""
    if noise == "singleton":
        lost = f"""numbered as (select idx as anchor, part,
        row_number() over (partition by part order by late, idx) + {start - 1} as cluster_id
      from (select seed as idx, part, 0 as late from (select distinct seed, part from placed) s
        union all select idx, part, 1 from fin where idx = t) n),
    anchored as (select idx, part, seed as anchor from placed
      union all select f.idx, f.part, coalesce(p.seed, f.t) from fin f left join placed p on p.idx = f.t),
    ids as (select a.idx, a.part, n.cluster_id from anchored a join numbered n on n.anchor = a.anchor)"""
    else:
        lost = f"""numbered as (select seed, part, row_number() over (partition by part order by seed) + {start - 1} as cluster_id
      from (select distinct seed, part from placed) s),
    ids as (select p.idx, p.part, coalesce(n.cluster_id,
        {start} + (select count(*) from numbered c where c.part = p.part)) as cluster_id
      from pts p left join placed l using (idx) left join numbered n on n.seed = l.seed)"""
    return f"""pts as materialized ({points}),
    {adjacency},
    deg as materialized (select p.idx, 1 + count(a.j) as n from pts p left join adj a on a.i = p.idx group by 1),
    core as materialized (select idx from deg where n >= {min_points}),
    link as materialized (select i, j from adj semi join core c on c.idx = i semi join core e on e.idx = j),
    reach(idx, r) as (select idx, idx from core union select reach.idx, link.j from reach join link on link.i = reach.r),
    comp as materialized (select idx, min(r) as seed from reach group by 1),
    border as materialized (select a.i as idx, coalesce(max(case when c.seed = a.j then c.seed end), min(c.seed)) as seed,
        min(c.seed) as first_seed
      from adj a join comp c on c.idx = a.j where a.i not in (select idx from core) group by 1),
    placed as materialized (select p.idx, p.part, coalesce(c.seed, b.seed) as seed from pts p left join comp c on c.idx = p.idx
      left join border b on b.idx = p.idx where coalesce(c.seed, b.seed) is not null),
    {NOISE_CHAINS},
    {lost},
    labelled as materialized (select i.part, i.idx, i.cluster_id,
        i.idx not in (select idx from core) and (b.first_seed is null or i.idx < b.first_seed) as met
      from ids i left join border b on b.idx = i.idx)"""


def creative_points(part: str = "0", where: str = "true") -> str:
    return f"select *, {part} as part from creatives where {where}"


def dbscan_hash(noise: str) -> str:
    return f"""with recursive creatives as materialized ({v.creatives_sql()}),
    {dbscan_ctes(creative_points(), hash_adjacency(EPS), MIN_POINTS, noise)}
    select idx, cluster_id from labelled"""


def dbscan_summary() -> str:
    return f"""with recursive creatives as materialized ({v.creatives_sql()}),
    {dbscan_ctes(creative_points(), hash_adjacency(EPS), MIN_POINTS)}
    select max(cluster_id) + 1 as next_id, count(*) filter (met) as noise_count from labelled"""


def dbscan_vectors() -> str:
    return f"""with recursive
    {dbscan_ctes(f"select *, 0 as part from ({v.vectors_sql()}) e", vector_adjacency(VECTOR_EPS), VECTOR_MIN)}
    select idx, aid, url, cluster_id from labelled join pts using (idx)"""


CLUSTER_FILE = """aid, uid, uname, '0' as rho, '0' as delta, {cid} as cluster_id, '0' as neighbor, wordlist, url,
    cast(hash as varchar) as simhash_emb, city"""


def cluster_industry(industry: str) -> str:
    return f"""with recursive creatives as materialized (
      select c.*, replace(text, ' ', ',') as wordlist from ({v.creatives_sql()}) c join documents on doc_id = idx),
    {dbscan_ctes(creative_points(where=f"lang = '{industry}'"), hash_adjacency(EPS), MIN_POINTS, start=10)}
    select idx, {CLUSTER_FILE.format(cid='cast(cluster_id as varchar)')} from labelled join pts using (idx)"""


INDUSTRIES = ("fr", "none", "en", "es", "de")


def cluster_industries(summary: bool = False) -> str:
    place = " ".join(f"when '{n}' then {k}" for k, n in enumerate(INDUSTRIES))
    points = creative_points(f"case lang {place} end", f"lang in ({', '.join(repr(n) for n in INDUSTRIES)})")
    adj = f"""adj as materialized (select * from (select a.part, a.idx as i, b.idx as j, {hash_d('a.hash', 'b.hash')} as d
    from pts a join pts b on a.part = b.part and a.idx <> b.idx) q where d < {EPS}::double)"""
    names = ", ".join(f"({k}, '{n}')" for k, n in enumerate(INDUSTRIES))
    body = f"""with recursive creatives as materialized ({v.creatives_sql()}),
    {dbscan_ctes(points, adj, MIN_POINTS)},
    names(part, industry) as (values {names}),
    used as (select part, industry, coalesce(max(cluster_id), 0) as ids, count(*) filter (met) as noise
      from names left join labelled using (part) group by all),
    runs as (select *, sum(ids) over (order by part) as upto, sum(noise) over (order by part) as noises from used)"""
    if summary:
        return f"{body} select industry, cast(upto + 10 as bigint) as next_id, cast(noises + 3 as bigint) as noise_count from runs"
    return f"{body} select idx, cast(cluster_id + upto - ids + 9 as bigint) as cluster_id from labelled join runs using (part)"


def refine() -> str:
    adj = f"""adj as materialized (select * from (select a.part, a.idx as i, b.idx as j,
      {hash_d('a.hash', 'b.hash')} + (case when a.uid = b.uid then 0 else 1 end) as d
    from pts a join pts b on a.part = b.part and a.idx <> b.idx) q where d < 0.15::double)"""
    points = "select *, lang as part from creatives where lang in (select lang from creatives group by 1 having count(*) >= 4)"
    return f"""with recursive creatives as materialized ({v.creatives_sql()}),
    {dbscan_ctes(points, adj, 2)}
    select idx, part || '_' || cluster_id as cluster_id from labelled"""


def dbscan_mixed() -> str:
    city = "1 - len(list_intersect(a.xs, b.xs)) / len(list_distinct(list_concat(a.xs, b.xs)))"
    adj = f"""adj as materialized (select * from (select a.part, a.idx as i, b.idx as j,
      greatest({hash_d('a.hash', 'b.hash')} + {USER}::double * (case when a.uname = b.uname then -1 else 1 end)
        + {COMPANY}::double * (case when a.coname = b.coname then -1 else 1 end) + {CITY}::double * ({city}), 0) as d
    from pts a join pts b on a.idx <> b.idx) q where d < {MIXED_EPS}::double)"""
    return f"""with recursive creatives as materialized (
      select *, string_split(city, ',') as xs from ({v.creatives_sql()}) c),
    {dbscan_ctes(creative_points(), adj, MIN_POINTS)}
    select idx, cluster_id from labelled"""


#: eps and weights of the mixes led by URL and by city.
LED_EPS, CITY_EPS, CITY_URL = 1.5, 0.45, 0.2
SHARED_HOSTS = ", ".join(f"'{h}'" for h in STOP_HOSTS)


#: Every third ad of the one-sided mix has no user.
ONE_SIDED_USER = 1.0


def dbscan_one_sided() -> str:
    """First the least core point that reaches a point along directed links, then the last seed next to it."""
    d = f"{hash_d('a.hash', 'b.hash')} + {ONE_SIDED_USER}::double * (case when a.uname = '0' or a.uname = b.uname then 0 else 1 end)"
    return f"""with recursive pts as materialized (
      select * replace (case when idx % 3 = 0 then '0' else uname end as uname), 0 as part from ({v.creatives_sql()}) c),
    adj as materialized (select * from (select a.idx as i, b.idx as j, {d} as d from pts a join pts b on a.idx <> b.idx) q
      where d < {MIXED_EPS}::double),
    core as materialized (select p.idx from pts p left join adj a on a.i = p.idx group by 1 having 1 + count(a.j) >= {MIN_POINTS}),
    link as materialized (select i, j from adj semi join core c on c.idx = i semi join core e on e.idx = j),
    reach(src, idx) as (select idx, idx from core union select reach.src, link.j from reach join link on link.i = reach.idx),
    held as materialized (select idx, min(src) as first from reach group by 1),
    beside as materialized (select a.j as idx, min(h.first) as first, max(case when h.first = a.i then a.i end) as taken
      from adj a join held h on h.idx = a.i group by 1),
    placed as materialized (select * from (select p.idx, p.part,
        coalesce(greatest(b.taken, case when h.first = p.idx then p.idx end), h.first, b.first) as seed
      from pts p left join held h on h.idx = p.idx left join beside b on b.idx = p.idx) q where seed is not null),
    {NOISE_CHAINS},
    numbered as (select idx as anchor, row_number() over (order by late, idx) as cluster_id
      from (select idx, 0 as late from held where first = idx union all select idx, 1 from fin where idx = t) n),
    anchored as (select idx, seed as anchor from placed
      union all select f.idx, coalesce(p.seed, f.t) from fin f left join placed p on p.idx = f.t)
    select a.idx, n.cluster_id from anchored a join numbered n on n.anchor = a.anchor"""


def _url_far() -> str:
    """1 where two URLs are far apart (two differing pieces, or another host), else 0."""
    differing = "len(list_filter(range(1, least(len(a.ps), len(b.ps)) + 1), lambda i: a.ps[i] <> b.ps[i]))"
    return f"""case when a.url = b.url or least(len(a.ps), len(b.ps)) = 0 then 0 when a.ps[1] <> b.ps[1] then 1
      when a.ps[1] in ({SHARED_HOSTS}) then 0 when {differing} >= 2 then 1 else 0 end"""


def _dbscan_parts(distance: str, eps: float) -> str:
    adj = f"""adj as materialized (select * from (select a.part, a.idx as i, b.idx as j, {distance} as d
    from pts a join pts b on a.idx <> b.idx) q where d < {eps}::double)"""
    return f"""with recursive creatives as materialized (
      select *, string_split(city, ',') as xs, string_split(url, '/')[3:] as ps from ({v.creatives_sql()}) c),
    {dbscan_ctes(creative_points(), adj, MIN_POINTS)}
    select idx, cluster_id from labelled"""


def dbscan_url_led() -> str:
    names = "(case when a.uname = '0' or b.uname = '0' or a.uname = b.uname then 0 else 1 end)"
    return _dbscan_parts(f"({_url_far()}) + {names} + (case when a.coname = b.coname then 0 else 1 end)", LED_EPS)


def dbscan_city_led() -> str:
    city = "1 - len(list_intersect(a.xs, b.xs)) / len(list_distinct(list_concat(a.xs, b.xs)))"
    return _dbscan_parts(f"{CITY_URL}::double * ({_url_far()}) + ({city})", CITY_EPS)


def refine_names() -> str:
    return f"""with creatives as ({v.creatives_sql()}),
    names as (select uname, row_number() over (order by min(idx)) as n from creatives group by 1)
    select idx, lang || '_' || n as cluster_id from creatives join names using (uname)"""


def neighbour_counts() -> str:
    return f"""with creatives as materialized ({v.creatives_sql()}), pts as materialized ({creative_points()}),
    {hash_adjacency(EPS)}
    select p.idx, 1 + count(a.j) as neighbours from pts p left join adj a on a.i = p.idx group by 1"""


def nearest() -> str:
    return f"""with creatives as materialized ({v.creatives_sql()}), pts as materialized ({creative_points()}),
    {hash_adjacency(EPS)}
    select i as idx, j as nearest, d from (
      select *, row_number() over (partition by i order by d, j) as rn from adj) r where rn = 1"""


def vector_neighbour_counts() -> str:
    return f"""with pts as materialized (select *, 0 as part from ({v.vectors_sql()}) e), {vector_adjacency(VECTOR_EPS)}
    select p.idx, 1 + count(a.j) as neighbours from pts p left join adj a on a.i = p.idx group by 1"""


def assignment() -> str:
    return f"""with recursive creatives as materialized ({v.creatives_sql()}),
    hist as materialized (select idx, hash, quality * 10 + toxic + 1 as cluster_id
      from creatives join labels on doc_id = idx),
    batch as materialized (select idx, hash from creatives where idx not in (select doc_id from labels)),
    earlier as materialized (
      select b.idx, 0 as late, h.idx as pos, {hash_d('b.hash', 'h.hash')} as d from batch b, hist h
      union all select b.idx, 1, e.idx, {hash_d('b.hash', 'e.hash')} from batch b join batch e on e.idx < b.idx),
    best as materialized (select * from (select *, row_number() over (partition by idx order by d, late, pos) as rn
      from earlier where d < {ASSIGN_EPS}::double) r where rn = 1),
    roots as materialized (select idx, row_number() over (order by idx) + (select max(cluster_id) from hist) as cluster_id
      from batch where idx not in (select idx from best)),
    walk(idx, late, pos) as (select idx, late, pos from best
      union select walk.idx, best.late, best.pos from walk join best on walk.late = 1 and best.idx = walk.pos)
    select idx, cluster_id from roots
    union all select w.idx, coalesce(h.cluster_id, r.cluster_id) from walk w
      left join hist h on w.late = 0 and h.idx = w.pos left join roots r on w.late = 1 and r.idx = w.pos
      where h.idx is not null or r.idx is not null"""


def profile() -> str:
    return f"""with creatives as materialized ({v.creatives_sql()}),
    pts as materialized (select *, row_number() over (order by idx) - 1 as position, count(*) over () as n from creatives),
    probe as (select distinct unnest([0, n // 4, 2 * (n // 4), n - n // 4, n - 1]) as probe from pts),
    dist as materialized (select probe, b.position, a.url as probe_label, b.url as nearest_label, b.n,
        {hash_d('a.hash', 'b.hash')} as d,
        row_number() over (partition by probe order by {hash_d('a.hash', 'b.hash')}, b.position) - 1 as rank
      from probe join pts a on a.position = probe, pts b)
    select probe, list(d order by rank) filter (rank < 50 and rank % 5 = 0) as head,
      floor(sum(d) * 1e6 + 0.5) / 1e6 as total, count(*) as points, floor(avg(d) * 1e6 + 0.5) / 1e6 as mean,
      max(d) filter (rank = 0) as q0, max(d) filter (rank = n // 4) as q1, max(d) filter (rank = 2 * (n // 4)) as q2,
      max(d) filter (rank = n - n // 4) as q3, max(d) filter (rank = n - 1) as q4,
      max(probe_label) filter (rank = 0) as probe_label, max(nearest_label) filter (rank = 0) as nearest_label
    from dist group by probe"""


def ranks(position: int) -> str:
    return f"""with pts as (select *, row_number() over (order by idx) - 1 as position from ({v.vectors_sql()}) e)
    select rank, sqrt(sq) as d from (select row_number() over (order by {SQUARED}, b.position) - 1 as rank, {SQUARED} as sq
      from pts a join pts b on a.position = {position} and b.position <> a.position) r
    where rank < 20 or rank % 500 = 0"""


def explain() -> str:
    def parts(u: str) -> str:
        return f"string_split({u}, '/')[3:]"

    stop = "['h5.gdt.qq.com','m.dianping.com','mp.weixin.qq.com','lp.pinduoduo.com','link.yiche.com','dmp-data.vip.com','aduland.dianping.com']"
    return f"""with ads as materialized ({v.page_ads_sql()}),
    p as (select a.aid as left_id, b.aid as right_id, a.hash as ha, b.hash as hb, a.url as ua, b.url as ub,
        {parts('a.url')} as pa, {parts('b.url')} as pb, a.uname as na, b.uname as nb, a.coname as ca, b.coname as cb,
        string_split(a.city, ',') as xa, string_split(b.city, ',') as xb
      from ads a join ads b on b.aid = a.aid + 1),
    q as (select *, least(len(pa), len(pb)) as m from p),
    r as (select *, len([k for k in range(1, m + 1) if pa[k] <> pb[k]]) as differing,
        coalesce(list_min([k for k in range(1, m + 1) if pa[k] <> pb[k]]) - 1, m) as common from q)
    select left_id, right_id, {hash_d('ha', 'hb')} as hash_distance,
      cast(case when ua = ub then -1 when m = 0 then 0 when pa[1] <> pb[1] then 1
        when list_contains({stop}, pa[1]) then 0 when differing >= 2 then 1 else -1 end as double) as url,
      cast(case when m = 0 or list_contains({stop}, pa[1]) or list_contains({stop}, pb[1]) then 0
        else 1 - 2 * (common / m) end as double) as url_prefix,
      cast(case when na = '0' then 0 when na = nb then -1 else 1 end as double) as uname,
      cast(case when ca = cb then -1 else 1 end as double) as coname,
      1 - len(list_intersect(xa, xb)) / len(list_distinct(list_concat(xa, xb))) as city
    from r"""


def vector_pairs() -> str:
    return f"""with e as (select vec_id, [{v.WHOLE} for x in embedding] as x from embeddings),
    p as (select a.vec_id as left_id, b.vec_id as right_id, a.x as x, b.x as y from e a join e b on b.vec_id = a.vec_id + 1),
    s as (select left_id, right_id, len(x) as n,
        list_sum([abs(x[k] - y[k]) for k in range(1, len(x) + 1)]) as l1,
        list_sum([(x[k] - y[k]) * (x[k] - y[k]) for k in range(1, len(x) + 1)]) as sq,
        list_sum([x[k] * y[k] for k in range(1, len(x) + 1)]) as dot,
        sqrt(list_sum([k * k for k in x])) as nx, sqrt(list_sum([k * k for k in y])) as ny,
        len([k for k in range(1, len(x) + 1) if x[k] * y[k] >= 0]) as same from p)
    select left_id, right_id, l1 / 12 as l1_twelfth, l1 / n as l1_mean, sqrt(sq) as l2, sqrt(sq) / 128 as l2_scaled,
      sq / n as l2_mean_square, 2 * sqrt(sq) / (nx + ny) as l2_relative, 1 - dot / (nx * ny) as cosine,
      same / n as sign_agreement from s"""


WORD = "^[a-z]{2,}$"


def idf() -> str:
    return f"""with w as (select unnest(string_split(text, ' ')) as word from documents)
    select word, floor(ln((select count(*) from documents) / count(*)) / ln(30000.0) * 1e6 + 0.5) / 1e6 as idf
    from w where regexp_matches(word, '{WORD}') group by word"""


def idf_override() -> str:
    return f"""with w as (select unnest(string_split(text, ' ')) as word from documents),
    f as (select word, count(*) as n from w group by word),
    b as (select word, count(*) as n from (select unnest(string_split(text, ' ')) as word from benchmark) t group by word)
    select f.word, floor(coalesce(b.n / 100, ln(32711 / f.n) / ln(30000.0)) * 1e6 + 0.5) / 1e6 as idf
    from f left join b using (word) where regexp_matches(f.word, '{WORD}')"""


def idf_diagnostics() -> str:
    return f"""with w as (select unnest(string_split(text, ' ')) as word from documents),
    f as (select word, count(*) as n, regexp_matches(word, '{WORD}') as kept from w group by word)
    select (select count(*) from documents) as documents, cast(sum(n) filter (not kept) as bigint) as dropped_tokens,
      count(*) filter (kept) as words, max(n) filter (kept) as max_count from f"""


TOKENS = "[string_split(t, ',')[1] for t in string_split(text, ' ') if len(string_split(t, ',')) = 2]"
LEVELS = {2: "cast(n_chars % 200 as {text})", 3: "case when lang = 'en' then cast(n_chars % 300 as {text}) else '' end"}


def token_parse() -> str:
    return f"select doc_id, array_to_string({TOKENS}, ' ') as wordlist from documents"


def _levels() -> str:
    return ", ".join(f"{e.format(text='varchar')} as l{k}" for k, e in LEVELS.items())


BAD = "({c} = '' or {c} = '0' or {c} like '%00')"


def label_lines() -> str:
    return f"""select doc_id, label, wordlist || ' __label__' || label as line from (
      select doc_id, array_to_string({TOKENS}, ' ') as wordlist,
        case when not {BAD.format(c='l3')} then l3 when not {BAD.format(c='l2')} then l2 end as label
      from (select *, {_levels()} from documents) d) t where label is not null"""


CODE = "cast('0x' || substr(md5(w), 1, 15) as bigint)"


SPLIT = "string_split(wordlist, ' ')"


def _hashed(rows: str, words: str) -> str:
    """(id, label, vector) of ``rows`` (id, label, text): signed counts of word hashes in 64 dimensions."""
    return f"""texts as ({rows}),
    w as (select id, unnest({words}) as w from texts),
    cells as (select id, cast({CODE} % 64 as integer) as slot, sum(case when {CODE} % 128 < 64 then 1 else -1 end) as x
      from w group by all),
    vectors as (select t.id, t.label, list(coalesce(c.x, 0)::bigint order by r.slot) as vector
      from texts t cross join (select unnest(range(64)) as slot) r left join cells c on c.id = t.id and c.slot = r.slot group by all)"""


def text_embedding() -> str:
    rows = f"""select doc_id as id, label, wordlist from (select doc_id, array_to_string({TOKENS}, ' ') as wordlist,
        case when not {BAD.format(c='l3')} then l3 when not {BAD.format(c='l2')} then l2 end as label
      from (select *, {_levels()} from documents) d) t where label is not null"""
    return f"with {_hashed(rows, SPLIT)} select id as doc_id, label, vector from vectors"


def label_quality() -> str:
    rows = "select doc_id as id, lang as label, text from documents"
    return f"""with {_hashed(rows, "string_split(text, ' ')")},
    sizes as (select label, count(*) as n from texts group by 1),
    centres as (select label, slot, sum(x) as s from cells join texts using (id) group by all),
    scores as (select c.id, k.label, cast(sum(c.x * k.s) as bigint) as product from cells c join centres k using (slot) group by all),
    best as (select id, arg_min(label, row(-product / n, label)) as label from scores join sizes using (label) group by 1)
    select count(*) as examples, count(distinct t.label) as labels, count(*) filter (b.label = t.label) as correct
    from texts t left join best b using (id)"""


def label_diagnostics() -> str:
    return f"""select count(*) filter (l3 = '0') as zero, count(*) filter (l3 like '%00') as double_zero,
      count(*) filter (l3 = '') as empty, count(*) filter ({BAD.format(c='l3')} and {BAD.format(c='l2')}) as removed
    from (select *, {_levels()} from documents) d"""


def next_partition() -> str:
    return """select event_id, strftime(cast(ts as date) + 3, '%Y%m%d') as next_day,
      strftime(date_trunc('hour', ts) + interval 30 hour, '%Y%m%d%H') as next_hour from events"""


def categories() -> str:
    return """select o_orderkey, case when o_custkey < 100 then o_custkey else o_custkey // 100 end as level_one,
      case when o_custkey < 100 then o_custkey else o_custkey / 100 end as level_one_plain, o_custkey as level_two from orders"""
