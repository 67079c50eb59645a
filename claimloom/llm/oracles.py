"""DuckDB twins of the llm queries that SQL can express."""

SITE = "regexp_extract(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({c})), '^[a-z][a-z0-9+.-]*://', ''), '[/?#].*$', ''), ':[0-9]*$', ''), '\\.+$', ''), '([^.]+\\.)?[^.]+$')"

SQL = {
    "p2_found": f"""
with caps as (
  select lower(regexp_replace(tier_id, '[ _-]+', '', 'g')) sp, tier_id, domain_cap from source_tiers
  union select lower(regexp_replace(label, '[ _-]+', '', 'g')), tier_id, domain_cap from source_tiers),
d as (
  select doc_id, coalesce(run_id, chr(1)) run_id, nullif({SITE.format(c='source_domain')}, '') site,
    lower(regexp_replace(coalesce(source_tier_id, ''), '[\\s_-]+', '', 'g')) sp, quality_score from documents),
t as (
  select d.*, coalesce(caps.tier_id, 'unclassified') tier,
    coalesce(caps.domain_cap, (select domain_cap from source_tiers where tier_id = 'unclassified')) cap
  from d left join caps using (sp) where site is not null),
r as (select doc_id, cap, row_number() over (partition by run_id, site, tier order by quality_score desc nulls last, doc_id) rn from t)
select doc_id from r where rn > cap""",
    "p2_share": f"""
with caps as (
  select lower(regexp_replace(tier_id, '[ _-]+', '', 'g')) sp, tier_id, domain_cap from source_tiers
  union select lower(regexp_replace(label, '[ _-]+', '', 'g')), tier_id, domain_cap from source_tiers),
d as (
  select doc_id, coalesce(run_id, chr(1)) run_id, count(*) over (partition by coalesce(run_id, chr(1))) pool, nullif({SITE.format(c='source_domain')}, '') site,
    lower(regexp_replace(coalesce(source_tier_id, ''), '[\\s_-]+', '', 'g')) sp, quality_score from documents),
t as (
  select d.*, coalesce(caps.tier_id, 'unclassified') tier,
    coalesce(caps.domain_cap, (select domain_cap from source_tiers where tier_id = 'unclassified')) cap
  from d left join caps using (sp) where site is not null),
r as (select doc_id, least(cap, greatest(1, cast(floor(pool * 0.01) as int))) cap, row_number() over (partition by run_id, site, tier order by quality_score desc nulls last, doc_id) rn from t)
select doc_id from r where rn > cap""",
    "p2_kept": f"""
with caps as (
  select lower(regexp_replace(tier_id, '[ _-]+', '', 'g')) sp, tier_id, domain_cap from source_tiers
  union select lower(regexp_replace(label, '[ _-]+', '', 'g')), tier_id, domain_cap from source_tiers),
d as (
  select doc_id, coalesce(run_id, chr(1)) run_id, nullif({SITE.format(c='source_domain')}, '') site,
    lower(regexp_replace(coalesce(source_tier_id, ''), '[\\s_-]+', '', 'g')) sp, quality_score from documents),
t as (
  select d.*, coalesce(caps.tier_id, 'unclassified') tier,
    coalesce(caps.domain_cap, (select domain_cap from source_tiers where tier_id = 'unclassified')) cap
  from d left join caps using (sp) where site is not null),
r as (select doc_id, cap, row_number() over (partition by run_id, site, tier order by quality_score desc nulls last, doc_id) rn from t)
select doc_id, source_domain, quality_score from documents where doc_id not in (select doc_id from r where rn > cap)""",
    "p7_found": f"""
with s as (select source_url, nullif({SITE.format(c='source_domain')}, '') site from source_documents),
c as (select distinct n.claim_id, n.claim_text, s.site from normalized_claims n join s using (source_url) where site is not null),
tot as (select site, count(distinct claim_id) n from c group by 1),
l as (select site, claim_id, unnest(string_split(claim_text, chr(10))) line, unnest(range(1, 1 + len(string_split(claim_text, chr(10))))) line_no from c),
k as (select site, claim_id, line_no, lower(regexp_replace(line, '[^\\p{{L}}]+', '', 'g')) letters from l),
f as (select site, letters, count(distinct claim_id) m from k where length(letters) >= 12 group by 1, 2)
select distinct k.claim_id, cast(k.line_no as int) line_no from k join f using (site, letters) join tot using (site) where f.m >= 8 and f.m >= 0.02 * tot.n""",
    "p1_found": """
with crop as (select lower(trim(n)) nm, min(crop_id) cid from (select crop_id, unnest(list_concat([label], coalesce(aliases, []), coalesce(scientific_names, []))) n from crops) group by 1),
d as (
  select durable_claim_id, promoted_at, coalesce(cid, lower(trim(entity_name))) crop, parameter_id, attribute_subtype,
    json_extract_string(location_scope_json, '$.geo_id') geo, json_extract_string(time_scope_json, '$.label') tl,
    json_extract_string(value_json, '$.value_type') vt,
    try_cast(json_extract_string(value_json, '$.numeric_value') as double) nv,
    try_cast(json_extract_string(value_json, '$.range_min') as double) r0,
    try_cast(json_extract_string(value_json, '$.range_max') as double) r1,
    nullif(json_extract_string(value_json, '$.text_value'), '') tv, nullif(json_extract_string(value_json, '$.unit'), '') un,
    coalesce(nullif(list_position(['canonical_candidate','merge_candidate','regional_observation','seasonal_observation','needs_review','reject'], regexp_replace(lower(trim(promotion_decision)), '[\\s-]+', '_', 'g')), 0), 7) dr,
    case when lower(trim(confidence)) = 'high' then 1 when lower(trim(confidence)) in ('medium', 'med') then 2 when lower(trim(confidence)) = 'low' then 3 else 4 end cr,
    case when json_valid(provenance_json) and json_type(case when json_valid(provenance_json) then provenance_json end) = 'OBJECT' then
      len(list_filter(json_keys(case when json_valid(provenance_json) then provenance_json end), lambda k: lower(trim(coalesce(json_extract_string(case when json_valid(provenance_json) then provenance_json end, '$.' || k), ''))) not in ('', '[]', 'n/a', 'unknown', '-', 'null')))
      else 0 end filled
  from durable_claims left join crop on lower(trim(entity_name)) = nm),
w as (select *, row_number() over (partition by crop, parameter_id, attribute_subtype, geo, tl, vt, nv, r0, r1, tv, un order by dr, cr, filled desc, promoted_at desc nulls last, durable_claim_id) rn,
   count(*) over (partition by crop, parameter_id, attribute_subtype, geo, tl, vt, nv, r0, r1, tv, un) n from d)
select durable_claim_id from w where rn = 1 and n > 1""",
    "p7_clean": f"""
with s as (select source_url, nullif({SITE.format(c='source_domain')}, '') site from source_documents),
c as (select distinct n.claim_id, n.claim_text, s.site from normalized_claims n join s using (source_url) where site is not null),
tot as (select site, count(distinct claim_id) n from c group by 1),
l as (select site, claim_id, unnest(string_split(claim_text, chr(10))) line, unnest(range(1, 1 + len(string_split(claim_text, chr(10))))) line_no from c),
k as (select site, claim_id, line_no, lower(regexp_replace(line, '[^\\p{{L}}]+', '', 'g')) letters from l),
f as (select site, letters, count(distinct claim_id) m from k where length(letters) >= 12 group by 1, 2),
o as (select k.claim_id, list(distinct k.line_no) nos from k join f using (site, letters) join tot using (site) where f.m >= 8 and f.m >= 0.02 * tot.n group by 1),
t as (select claim_id, any_value(claim_text) claim_text from normalized_claims group by 1)
select claim_id, case when o.nos is null then claim_text else array_to_string(list_filter(string_split(claim_text, chr(10)), lambda x, i: not list_contains(o.nos, i)), chr(10)) end claim_text from t left join o using (claim_id)""",
}
