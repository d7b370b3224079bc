"""The notice queries once more, as SQL over the same tables."""

from tallyleaf.functions import text
from tallyleaf.functions.minhash import PRIME, banding_threshold, hash_family
from tallyleaf.operators import evaluate, lsh, verify
from tallyleaf.plans import notices
from tallyleaf.sources import tables


def _regexp(value, pattern, by=""):
    return f"regexp_replace({value}, '{pattern}', '{by}', 'g')"


def _words_only(value):
    return f"trim({_regexp(f'lower({value})', text.NOT_ALPHANUMERIC, ' ')})"


def _raw(title, body):
    return f"lower({title} || ' ' || {body})"


def _raw_words(title, body):
    return f"trim({_regexp(_raw(title, body), text.BLANKS, ' ')})"


def _processed(title, body):
    tail = f"substr({body}, position('{text.PREAMBLE_END}' in {body}))"
    rest = f"""case when regexp_matches({tail}, '{text.DASH_RUN}')
      then regexp_replace({tail}, '(?s)^.*?{text.DASH_RUN}', '') else substr({tail}, {len(text.PREAMBLE_END) + 1}) end"""
    rule = f"substr({body}, position('{text.PREAMBLE_RULE}' in {body}) + {len(text.PREAMBLE_RULE)})"
    core = f"""(case when contains({body}, '{text.PREAMBLE_END}') then {rest}
      when contains({body}, '{text.PREAMBLE_RULE}') then {rule} else {body} end)"""
    core = f"split_part(split_part({core}, '{text.FOOTER_RULE}', 1), '{text.TRUNCATION_MARK}', 1)"
    head = _regexp(_regexp(title, text.TITLE_PREFIXES), text.TITLE_REFERENCE)
    full = _regexp(f"({head} || ' ' || {core})", text.REFERENCE_LINE)
    for pattern in text.DATE_PATTERNS:
        full = _regexp(full, pattern)
    return _words_only(full)


def _sets(value, n, name="sets", unit="word", source="docs"):
    """Distinct n-grams per notice, as rows (``<name>_rows``) and as a list."""
    split, joint = (" ", " || ' ' || ") if unit == "word" else ("", " || ")
    gram = joint.join(["w", *[f"lead(w, {k}) over following" for k in range(1, n)]])
    leads = ", ".join(f"lead(w, {k}) over following" for k in range(1, n))
    # concat skips the missing ones, so the first row of a short text gives the whole text.
    short = "w" if unit == "word" else f"case when i = 1 then concat(w, {leads}) end"
    return f"""
{name}_tokens as (
  select notice_id, unnest(string_split({value}, '{split}')) as w,
    generate_subscripts(string_split({value}, '{split}'), 1) as i
  from {source} where {value} <> ''),
{name}_rows as materialized (
  select distinct notice_id, s from (
    select notice_id, case when count(*) over (partition by notice_id) < {n} then {short} else {gram} end as s
    from {name}_tokens window following as (partition by notice_id order by i))
  where s is not null),
{name} as materialized (
  select notice_id, coalesce(list(s) filter (s is not null), []) as shingles
  from {source} left join {name}_rows using (notice_id) group by notice_id)"""


def _hash60(value):
    return f"cast('0x' || substr(md5({value}), 1, 15) as bigint)"


DOCS = f"""
docs as materialized (
  select doc_id as notice_id, source as portal_id, lang as estimated_value, text as body,
    {_raw("''", "text")} as raw, {_raw_words("''", "text")} as raw_words, {_words_only("text")} as naive, {_processed("''", "text")} as processed
  from documents)"""

CLUSTERS = """
clusters as materialized (
  select doc_id as notice_id, min(doc_id) over (partition by text) as cluster_id,
    doc_id - min(doc_id) over (partition by text) as copy_index, lang as archetype
  from documents)"""

PAIRS = f"""{_sets("naive", 3, "openers")},
lows as materialized (
  select notice_id, portal_id, estimated_value, length(any_value(naive)) as size,
    coalesce(min({_hash60("s")}), -1) as lowest
  from docs left join openers_rows using (notice_id) group by notice_id, portal_id, estimated_value),
starred as (
  select distinct * from (
    select min(notice_id) over (partition by lowest) as id_a, notice_id as id_b from lows
    union all
    select min(notice_id) over (partition by portal_id, estimated_value), notice_id from lows)
  where id_a < id_b),
pairs as materialized (
  select id_a, id_b, case when a.lowest = b.lowest and 10 * least(a.size, b.size) >= 9 * greatest(a.size, b.size)
    then 'same' else 'different' end as label
  from starred join lows a on a.notice_id = id_a join lows b on b.notice_id = id_b)"""


def _scored(sets="sets", name="scored"):
    return f"""
{name} as materialized (
  select *, size_a + size_b - shared as united,
    case when size_a = 0 or size_b = 0 then 0.0 else cast(shared as double) / (size_a + size_b - shared) end as jaccard
  from (
    select id_a, id_b, label, cast(len(list_intersect(a.shingles, b.shingles)) as integer) as shared,
      cast(len(a.shingles) as integer) as size_a, cast(len(b.shingles) as integer) as size_b
    from pairs join {sets} a on a.notice_id = id_a join {sets} b on b.notice_id = id_b))"""


def _sigs(sets="sets", k=lsh.K, tag=""):
    family = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(hash_family(k)))
    return f"""
hashed{tag} as materialized (
  select notice_id, {_hash60("s")} % {PRIME} as h from {sets}_rows),
sigs{tag} as materialized (
  select notice_id, i, min((h * a + b) % {PRIME}) as m
  from hashed{tag}, (values {family}) as family(i, a, b) group by notice_id, i)"""


def _posts(rows, tag=""):
    return f"""
posts{tag} as materialized (
  select notice_id, cast(i // {rows} as integer) as band_id,
    {_hash60(f"(i // {rows}) || ':' || string_agg(m, ',' order by i)")} as bucket_id
  from sigs{tag} group by notice_id, i // {rows}),
sizes{tag} as materialized (
  select band_id, bucket_id, count(*) as bucket_size from posts{tag} group by band_id, bucket_id)"""


def _candidates(tag="", name="cands", cap=None):
    capped = f" semi join (select * from sizes{tag} where bucket_size <= {cap}) using (band_id, bucket_id)" if cap else ""
    return f"""
{name} as materialized (
  select distinct a.notice_id as id_a, b.notice_id as id_b
  from (select * from posts{tag}{capped}) a join posts{tag} b on a.band_id = b.band_id and a.bucket_id = b.bucket_id
  where a.notice_id < b.notice_id)"""


def _summary(tag="", cands="cands", cap=None):
    """Scalar subqueries of one retrieval configuration."""
    most = f"and bucket_size <= {cap}" if cap else ""
    work = f"""(select notice_id, sum(bucket_size - 1) as work from posts{tag} join sizes{tag} using (band_id, bucket_id)
      where bucket_size > 1 {most} group by notice_id)"""

    def at(p):
        return f"(select coalesce(round(quantile_cont(work, {p}), 6), 0) from {work})"

    return {
        "buckets": f"(select count(*) from sizes{tag})",
        "multi_buckets": f"(select count(*) from sizes{tag} where bucket_size > 1)",
        "max_bucket_size": f"(select max(bucket_size) from sizes{tag})",
        "bucket_pairs": f"(select cast(sum(bucket_size * (bucket_size - 1) // 2) as bigint) from sizes{tag})",
        "notices": f"(select count(*) from {work})",
        "p50_work": at(0.5),
        "p90_work": at(0.9),
        "p99_work": at(0.99),
        "p999_work": at(0.999),
        "max_work": f"(select coalesce(cast(max(work) as double), 0) from {work})",
        "unique_candidates": f"(select count(*) from {cands})",
    }


def _select(columns):
    return "select " + ", ".join(f"{v} as {k}" for k, v in columns.items())


WORD2 = _sets("processed", 2)
WORD3 = _sets("processed", 3)
BANDED = f"with {DOCS}, {WORD2}, {_sigs()}, {_posts(lsh.ROWS)}"
LEVEL = "case when united > 0 then 100 * shared // united else 0 end"

SWEEP = f"""
counts as (
  select step, count(*) filter (label = 'same' and level >= step) as tp,
    count(*) filter (label = 'different' and level >= step) as fp,
    count(*) filter (label = 'same' and level < step) as fn
  from (select label, {LEVEL} as level from scored), range(1, 100) as steps(step) group by step),
sweep as (
  select cast(step as double) / 100 as threshold, tp, fp, fn,
    case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision,
    case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall,
    case when tp > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end as f1,
    {evaluate.FALSE_MERGE_COST} * fp + fn as cost
  from counts)"""

def _verified(threshold):
    return f"""{BANDED}, {_candidates()}, {_sets('processed', 3, 'sets3')},
firsts as (
  select min(notice_id) as notice_id, estimated_value from docs where processed <> '' group by processed, estimated_value),
verified as materialized (
  select id_a, id_b, cast(len(list_intersect(a.shingles, b.shingles)) as double)
    / (len(a.shingles) + len(b.shingles) - len(list_intersect(a.shingles, b.shingles))) as jaccard
  from cands
    join firsts fa on fa.notice_id = id_a join firsts fb on fb.notice_id = id_b
    join sets3 a on a.notice_id = id_a join sets3 b on b.notice_id = id_b
  where fa.estimated_value = fb.estimated_value
    and cast(len(list_intersect(a.shingles, b.shingles)) as double)
      / (len(a.shingles) + len(b.shingles) - len(list_intersect(a.shingles, b.shingles))) >= {threshold})"""


VERIFIED = _verified(verify.THRESHOLD)

LINKS = """
links as materialized (
  select id_a, id_b from verified
  union all
  select a.notice_id, b.notice_id from docs a join docs b
    on a.processed = b.processed and a.estimated_value = b.estimated_value and a.notice_id < b.notice_id
  where a.processed <> '')"""


def _components(nodes, name):
    return f"""
{name}_reach(a, b) as (
  select notice_id, notice_id from {nodes}
  union
  select r.a, case when l.id_a = r.b then l.id_b else l.id_a end
  from {name}_reach r join links l on l.id_a = r.b or l.id_b = r.b
  where case when l.id_a = r.b then l.id_b else l.id_a end in (select notice_id from {nodes})),
{name} as (select a as notice_id, min(b) as component from {name}_reach group by a)"""


CARDS = VERIFIED.replace("with ", "with recursive ", 1) + f", {LINKS}"
def _rerun(early):
    return f"""{CARDS},
early as ({early}),
{_components("early", "old")}, {_components("docs", "new")},
carried as (select distinct new.component, old.component as old_id from old join new using (notice_id)),
kept as (select component, min('CARD-' || old_id) as kept_id from carried group by component)"""


RERUN = _rerun("select doc_id as notice_id from labels")

CLASSED = """
classed as materialized (
  select notice_id, case when processed <> '' and estimated_value is not null
    then min(notice_id) over (partition by processed, estimated_value) else notice_id end as class_id from docs)"""


def _week(name, where):
    """Components of the notices of a week and those before: over classes of copies, as a later week may bring the lowest copy."""
    return f"""
{name}_classes as (select distinct class_id as notice_id from classed where {where}),
{_components(f"{name}_classes", f"{name}_groups")},
{name} as materialized (
  select c.notice_id, min(c.notice_id) over (partition by g.component) as component
  from classed c join {name}_groups g on c.class_id = g.notice_id where {where.replace("notice_id", "c.notice_id")})"""


WEEKS = f"""{_verified(tables.WEEKLY_THRESHOLD).replace("with ", "with recursive ", 1)}, {CLASSED},
links as materialized (select id_a, id_b from verified),
{_week("old", f"notice_id % {tables.WEEK_OF} <> {tables.SECOND_WEEK}")}, {_week("new", "true")},
carried as (select distinct new.component, old.component as old_id from old join new using (notice_id)),
kept as (select component, min('CARD-' || old_id) as kept_id from carried group by component)"""
RERUN_CARDS = "select coalesce(kept_id, 'CARD-' || component) as card_id, notice_id from new left join kept using (component)"
RERUN_REDIRECTS = """
select 'CARD-' || old_id as old_card_id, kept_id as canonical_card_id from carried join kept using (component)
where 'CARD-' || old_id <> kept_id"""


def _representations():
    ctes, rows = [], []
    for i, (name, cleaner, unit, n) in enumerate(evaluate.REPRESENTATIONS):
        ctes += [
            _sets(cleaner, n, f"sets{i}", unit),
            _scored(f"sets{i}", f"scored{i}"),
            f"""best{i} as (
  select step, case when tp > 0 then 2 * tp / (tp + fp + same) else 0.0 end as f1 from (
    select step, count(*) filter (label = 'same' and level >= step) as tp,
      count(*) filter (label = 'different' and level >= step) as fp, count(*) filter (label = 'same') as same
    from (select label, {LEVEL} as level from scored{i}), range(1, 100) as steps(step) group by step)
  order by f1 desc, step limit 1)""",
        ]
        rows.append(f"""
select '{name}' as representation, round(sum(size_a + size_b) / (2 * count(*)), 6) as mean_shingles,
  round(avg(jaccard) filter (label = 'same'), 6) as same_mean,
  round(avg(jaccard) filter (label = 'different'), 6) as different_mean,
  max(jaccard) filter (label = 'different') as different_max, min(jaccard) filter (label = 'same') as same_min,
  (select f1 from best{i}) as best_f1, (select cast(step as double) / 100 from best{i}) as best_threshold
from scored{i}""")
    return f"with {DOCS}, {PAIRS}, {', '.join(ctes)} {' union all '.join(rows)}"


def _mitigations():
    ctes = [WORD2, _sets("processed", 3, "sets3")]
    ctes.append(f"""
pruned_rows as materialized (
  select * from sets_rows where s not in (
    select s from sets_rows group by s having count(*) > (select floor(count(*) * {lsh.DF_SHARE}) from docs)))""")
    made, rows = {}, []
    for i, (name, n, pruned, bands, per_band, cap) in enumerate(notices.MITIGATIONS):
        key = (n, pruned, bands)
        if key not in made:
            made[key] = f"_{i}"
            ctes += [_sigs("pruned" if pruned else "sets" if n == 2 else "sets3", tag=f"_{i}"), _posts(per_band, f"_{i}")]
        ctes.append(_candidates(made[key], f"cands{i}", cap))
        part = _summary(made[key], f"cands{i}", cap)
        hits = f"(select count(*) from same_pairs semi join cands{i} using (id_a, id_b))"
        columns = {"strategy": f"'{name}'", "hits": hits, "recall": f"{hits} / (select count(*) from same_pairs)"}
        chosen = ("unique_candidates", "bucket_pairs", "max_bucket_size", "p50_work", "p90_work", "p99_work", "max_work")
        rows.append(_select({**columns, **{c: part[c] for c in chosen}}))
    same = "same_pairs as materialized (select id_a, id_b from pairs where label = 'same')"
    return f"with {DOCS}, {PAIRS}, {same}, {', '.join(ctes)} {' union all '.join(rows)}"


def _naive_vs_processed():
    ctes, rows = [], []
    for how in ("naive", "processed"):
        ctes += [
            _sets(how, 2, f"sets_{how}"),
            _sigs(f"sets_{how}", tag=f"_{how}"),
            _posts(lsh.ROWS, f"_{how}"),
            _candidates(f"_{how}", name=f"cands_{how}"),
        ]
        rows.append(_select({"text": f"'{how}'", **_summary(f"_{how}", cands=f"cands_{how}")}))
    return f"with {DOCS}, {', '.join(ctes)} {' union all '.join(rows)}"


def _bucket_stats():
    rows = []
    for bands, per_band in ((16, 8), (32, 4)):
        part = _summary(f"_{bands}")
        columns = ("buckets", "multi_buckets", "max_bucket_size", "bucket_pairs")
        rows.append(_select({"bands": bands, "rows": per_band, **{c: part[c] for c in columns}}))
    ctes = [_sets("naive", 2)]
    for bands, per_band in ((16, 8), (32, 4)):
        ctes += [_sigs(tag=f"_{bands}"), _posts(per_band, f"_{bands}")]
    return f"with {DOCS}, {', '.join(ctes)} {' union all '.join(rows)}"


def _winning():
    first = notices.WINNING_BAND * lsh.ROWS
    family = hash_family(first + lsh.ROWS)[first:]
    values = ", ".join(f"({first + i}, {a}, {b})" for i, (a, b) in enumerate(family))
    return f"""{BANDED},
top as (select * from sizes where band_id = {notices.WINNING_BAND} order by bucket_size desc, bucket_id limit 1),
members as (select notice_id from posts semi join top using (band_id, bucket_id)),
scored as (
  select notice_id, hash_no, s as shingle, ({_hash60("s")} % {PRIME} * a + b) % {PRIME} as value
  from sets_rows semi join members using (notice_id),
    (values {values}) as family(hash_no, a, b))
select notice_id, hash_no, shingle, value from scored
qualify row_number() over (partition by notice_id, hash_no order by value, shingle) = 1"""


def _digests(table, key, title, body):
    processed = _processed(title, body)
    return f"""
select {key} as notice_id, md5({_raw(title, body)}) as raw_md5,
  md5({_words_only(f"({title} || ' ' || {body})")}) as naive_md5, md5(processed) as processed_md5,
  cast(length(processed) as integer) as processed_length
from (select *, {processed} as processed from {table})"""


PROBE = f"""{BANDED},
batch as materialized (select item_id as notice_id, {_processed("''", "text")} as processed from benchmark),
{_sets("processed", 2, "batch_sets", source="batch")}, {_sigs("batch_sets", tag="_batch")}, {_posts(lsh.ROWS, "_batch")}
select q.notice_id as incoming_id, p.notice_id, count(*) as shared_bands
from posts_batch q join posts p using (band_id, bucket_id) group by all"""

_SIZES = ", ".join(f"({k})" for k in evaluate.SIGNATURE_SIZES)

ORACLE = {
    "corpus_counts": f"""with {CLUSTERS}
select archetype, count(*) as notices, count(distinct source) as portals
from clusters join documents on doc_id = notice_id group by archetype""",
    "shared_values": f"""with {CLUSTERS}
select lang as estimated_value, count(distinct cluster_id) as clusters, count(*) as notices
from clusters join documents on doc_id = notice_id group by 1 order by clusters desc, estimated_value limit 10""",
    "cluster_consistency": f"""with {CLUSTERS},
sized as (
  select cluster_id, count(distinct lang) as n_values
  from clusters join documents on doc_id = notice_id group by cluster_id having count(*) > 1)
select count(*) as multi_clusters, count(*) filter (n_values = 1) as one_value,
  count(*) filter (n_values > 1) as several_values
from sized""",
    "first_per_archetype": f"""with {CLUSTERS}
select archetype, notice_id, source as portal_id, cluster_id from clusters join documents on doc_id = notice_id
qualify row_number() over (partition by archetype order by notice_id) = 1""",
    "cluster_members": f"""with {CLUSTERS}
select cluster_id, copy_index, notice_id, source as portal_id, cast(length(text) as integer) as body_length
from clusters join documents on doc_id = notice_id
where cluster_id in (select cluster_id from clusters group by cluster_id having count(*) > 1)""",
    "label_truth_mismatches": f"""with {DOCS}, {PAIRS}, {CLUSTERS}
select count(*) as pairs, count(*) filter ((a.cluster_id = b.cluster_id) <> (label = 'same')) as mismatches
from pairs join clusters a on a.notice_id = id_a join clusters b on b.notice_id = id_b""",
    "cleaned_documents": _digests("documents", "doc_id", "''", "text"),
    "cleaned_pages": _digests("pages", "page_id", "url", "html"),
    "shingle_counts": f"""with {DOCS}, {_sets("raw", 5, "r5", "char")}, {_sets("processed", 5, "c5", "char")},
{_sets("processed", 1, "w1")}, {_sets("processed", 2, "w2")}, {_sets("processed", 3, "w3")}
select notice_id, cast(len(r5.shingles) as integer) as raw_char5, cast(len(c5.shingles) as integer) as char5,
  cast(len(w1.shingles) as integer) as word1, cast(len(w2.shingles) as integer) as word2,
  cast(len(w3.shingles) as integer) as word3
from r5 join c5 using (notice_id) join w1 using (notice_id) join w2 using (notice_id) join w3 using (notice_id)""",
    "document_frequency": f"""with {DOCS}, {WORD2},
counts as (select s, count(*) as df from sets_rows group by s)
select df, count(*) as shingles from counts group by df""",
    "frequent_shingles": f"""with {DOCS}, {WORD2}
select s as shingle, count(*) as df from sets_rows group by s
having count(*) > (select floor(count(*) * {lsh.DF_SHARE}) from documents)""",
    "portal_prefixes": r"""with ends as (
  select regexp_extract(url, '^https?://[^/]*\.([a-z]+)', 1) as portal_id, count(*) as notices, min(html) as lowest,
    max(html) as highest
  from pages group by 1),
chars as (
  select portal_id, generate_subscripts(string_split(lowest, ''), 1) as i, unnest(string_split(lowest, '')) as c,
    unnest(string_split(highest, '')) as d
  from ends),
ended as (select portal_id, min(i) - 1 as n from chars where c is distinct from d group by portal_id)
select portal_id, notices, cast(coalesce(n, length(lowest)) as integer) as prefix_length,
  substr(lowest, 1, coalesce(n, length(lowest))) as prefix
from ends left join ended using (portal_id)""",
    "labelled_pairs": f"with {DOCS}, {PAIRS} select * from pairs",
    "pair_scores": f"""with {DOCS}, {PAIRS}, {WORD2}, {_scored()}
select id_a, id_b, label, shared, united, jaccard from scored""",
    "class_stats": f"""with {DOCS}, {PAIRS}, {WORD2}, {_scored()}
select label, count(*) as pairs, min(jaccard) as min_jaccard, round(avg(jaccard), 6) as mean_jaccard,
  max(jaccard) as max_jaccard
from scored group by label""",
    "threshold_sweep": f"with {DOCS}, {PAIRS}, {WORD3}, {_scored()}, {SWEEP} select * from sweep",
    "best_f1": f"""with {DOCS}, {PAIRS}, {WORD3}, {_scored()}, {SWEEP}
select threshold, f1 from sweep order by f1 desc, threshold limit 1""",
    "operating_point": f"""with {DOCS}, {PAIRS}, {WORD3}, {_scored()}, {SWEEP}
select * from sweep order by cost, threshold limit 1""",
    "representations": _representations(),
    "signature_error": f"""with {DOCS}, {PAIRS}, {WORD2}, {_scored()}, {_sigs(k=max(evaluate.SIGNATURE_SIZES))},
compared as (
  select k, jaccard as s, count(*) filter (a.m = b.m) / k - jaccard as error
  from scored join sigs a on a.notice_id = id_a join sigs b on b.notice_id = id_b and a.i = b.i,
    (values {_SIZES}) as sizes(k)
  where a.i < k group by id_a, id_b, k, jaccard)
select k, count(*) as pairs, round(avg(abs(error)), 6) as mae, round(sqrt(avg(error * error)), 6) as rmse,
  round(max(abs(error)), 6) as max_error, round(avg(sqrt(s * (1 - s) / k)), 6) as theoretical_se
from compared group by k""",
    "signatures": f"""with {DOCS}, {WORD2}, {_sigs()}
select notice_id, md5(string_agg(m, ',' order by i)) as signature_md5 from sigs group by notice_id""",
    "lsh_postings": f"{BANDED} select band_id, bucket_id, notice_id from posts",
    "bucket_stats": _bucket_stats(),
    "top_buckets": f"""{BANDED}
select * from sizes order by bucket_size desc, band_id, bucket_id limit 10""",
    "largest_bucket_portals": f"""{BANDED},
top as (select * from sizes order by bucket_size desc, band_id, bucket_id limit 1)
select bucket_size, portal_id, count(*) as notices
from posts join top using (band_id, bucket_id) join docs using (notice_id)
group by all order by notices desc, portal_id limit 10""",
    "naive_vs_processed": _naive_vs_processed(),
    "mitigations": _mitigations(),
    "work_percentiles": f"""{BANDED}
{_select({c: _summary()[c] for c in ("notices", "p50_work", "p90_work", "p99_work", "p999_work", "max_work")})}""",
    "candidates": f"{BANDED}, {_candidates()} select * from cands",
    "label_recall": f"""with {DOCS}, {PAIRS}, {WORD2}, {_sigs()}, {_posts(lsh.ROWS)}, {_candidates()}
select count(*) as hits from pairs semi join cands using (id_a, id_b) where label = 'same'""",
    "winning_shingles": _winning(),
    "retrieval_curve": f"""with {DOCS}, {PAIRS}, {WORD2}, {_scored()}, {_sigs()}, {_posts(lsh.ROWS)}, {_candidates()}
select cast(case when united > 0 then 10 * shared // united else 0 end as integer) as score_bin, count(*) as pairs,
  count(c.id_a) as retrieved, round(avg(1 - pow(1 - pow(jaccard, {lsh.ROWS}), {lsh.BANDS})), 6) as expected_share,
  max(cast(case when united > 0 then 10 * shared // united else 0 end / 10 >= {banding_threshold(lsh.BANDS, lsh.ROWS)} as integer)) as above_threshold
from scored s left join cands c on c.id_a = s.id_a and c.id_b = s.id_b group by 1""",
    "index_probe": PROBE,
    "stored_index_probe": PROBE,
    "stored_index_lookup": f"select * from ({PROBE}) where incoming_id = (select min(item_id) from benchmark)",
    "verified_pairs": f"{VERIFIED} select * from verified",
    "verified_classes": f"""{VERIFIED}, {CLASSED},
sized as (select class_id, count(*) as class_size from classed group by class_id),
linked as (
  select class_id, cast(sum(class_size) as bigint) as others
  from (select id_a as class_id, id_b as other from verified union all select id_b, id_a from verified)
    join (select class_id as other, class_size from sized) using (other) group by class_id)
select notice_id, class_id, class_size, class_size - 1 + coalesce(others, 0) as n_links
from classed join sized using (class_id) left join linked using (class_id)""",
    "card_membership": f"""{CARDS}, {_components("docs", "cards")}
select 'CARD-' || component as card_id, notice_id from cards""",
    "card_rerun": f"{RERUN} {RERUN_CARDS}",
    "card_redirects": f"{RERUN} {RERUN_REDIRECTS}",
}
INCREMENTAL_ORACLE = {
    "incremental_cards": f"{WEEKS} {RERUN_CARDS}",
    "incremental_redirects": f"{WEEKS} {RERUN_REDIRECTS}",
}
