"""DuckDB SQL for the queries of the catalogue, over the same tables.

Means of whole numbers are rounded in integer arithmetic, half away from zero, so the text
does not depend on how an engine rounds doubles.
"""

from __future__ import annotations


def mean2(total: str, count: str) -> str:
    return f"cast((200 * ({total}) + ({count})) // (2 * ({count})) as double) / 100"


def mean_decimal(total: str, count: str) -> str:
    return f"cast({mean2(total, count)} as decimal(10,2))"


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"


# -- the photo model -----------------------------------------------------------------------

PHOTO_TAGS = """
photo_tags as (
 select cast(l_orderkey as varchar) as id, cast(pos as int) as pos, tag from (
  select l_orderkey, lower(tag) as tag, row_number() over (partition by l_orderkey
    order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
             l_tax, l_shipdate, k) as pos
  from (select l.*, 1 as k, p_type as tag from lineitem l join part p on l.l_partkey = p.p_partkey
        union all
        select l.*, 2 as k, split_part(p_name, ' ', 2) as tag
        from lineitem l join part p on l.l_partkey = p.p_partkey) x) y)
"""

PHOTOS = """
photos as (
 select cast(o.o_orderkey as varchar) as id, o.o_orderdate as created_at,
  cast(1000 + (o.o_orderkey * 37) % 3000 as int) as width,
  cast(case when o.o_orderkey % 11 = 0 then 1000 + (o.o_orderkey * 37) % 3000
            else 1000 + (o.o_orderkey * 53) % 3000 end as int) as height,
  case when o.o_orderkey % 13 = 0 then null else cast(g.qty as bigint) end as likes,
  cast(coalesce(g.n, 0) * 5 as bigint) as downloads,
  case when o.o_orderkey % 7 = 0 then 0 else cast(floor(o.o_totalprice / 10) as bigint) end as views,
  case when o.o_orderkey % 101 = 0 then null else cast(o.o_custkey as varchar) end as user_id,
  c.c_name as user_username, c.c_mktsegment as user_name, g.color
 from orders o join customer c on o.o_custkey = c.c_custkey
 left join (select l_orderkey, sum(l_quantity) as qty, count(*) as n, min(p_brand) as color
            from lineitem join part on l_partkey = p_partkey group by l_orderkey) g
   on g.l_orderkey = o.o_orderkey)
"""

STG = f"""
{PHOTOS}, {PHOTO_TAGS},
stg as (
 select p.id, created_at, width, height, color, coalesce(downloads, 0) as downloads,
  coalesce(likes, 0) as likes, coalesce(views, 0) as views, user_id, user_username, user_name,
  case when height <> 0 then cast(width as double) / height end as aspect_ratio,
  case when width > height then 'landscape' when height > width then 'portrait'
       else 'square' end as orientation,
  case when views > 0 then cast(likes as double) / views * 100 else 0 end as like_rate,
  case when views > 0 then cast(downloads as double) / views * 100 else 0 end as download_rate,
  cast(date '2001-08-01' - cast(created_at as date) as int) as days_since_created,
  t.tag as primary_tag
 from photos p left join photo_tags t on t.id = p.id and t.pos = 1),
tagged as (select s.*, t.pos, t.tag from stg s join photo_tags t on t.id = s.id)
"""

DAILY_TAGS = """
daily_tags as (
 select * from (
  select *, cast(row_number() over (partition by trend_date order by "count" desc, tag) as int)
   as position from (select cast(created_at as date) as trend_date, tag, count(*) as "count"
        from tagged group by all)) where position <= 10),
daily_colors as (
 select * from (
  select *, cast(row_number() over (partition by trend_date order by "count" desc, color) as int)
   as position from (select cast(created_at as date) as trend_date, color, count(*) as "count"
        from stg where color is not null group by all)) where position <= 10)
"""

NESTED = """
nested_tags as (
 select trend_date, cast(to_json(list({'tag': tag, 'count': "count"} order by position))
   as varchar) as top_tags from daily_tags group by trend_date),
nested_colors as (
 select trend_date, cast(to_json(list({'color': color, 'count': "count"} order by position))
   as varchar) as top_colors from daily_colors group by trend_date)
"""

DAILY_STATS = f"""
daily_stats as (
 select cast(created_at as date) as trend_date, count(distinct id) as total_photos,
  {big("sum(likes)")} as total_likes, {big("sum(downloads)")} as total_downloads,
  {big("sum(views)")} as total_views,
  {mean2("sum(likes)", "count(*)")} as avg_likes_per_photo,
  {mean2("sum(downloads)", "count(*)")} as avg_downloads_per_photo,
  {mean2("sum(views)", "count(*)")} as avg_views_per_photo,
  round(avg(like_rate), 2) as avg_like_rate, round(avg(download_rate), 2) as avg_download_rate,
  count(distinct user_id) as unique_photographers, round(avg(aspect_ratio), 2) as avg_aspect_ratio,
  count(case when orientation = 'landscape' then 1 end) as landscape_photos,
  count(case when orientation = 'portrait' then 1 end) as portrait_photos,
  count(case when orientation = 'square' then 1 end) as square_photos
 from stg group by 1)
"""

MART_DAILY = f"""
with {STG}, {DAILY_TAGS}, {NESTED}, {DAILY_STATS}
select d.*, top_tags, top_colors from daily_stats d
left join nested_tags using (trend_date) left join nested_colors using (trend_date)
"""

DAILY_TRENDS = f"""
{STG}, {DAILY_TAGS}, {NESTED},
daily_trends as (
 select d.*, coalesce(top_tags, '[]') as top_tags, coalesce(top_colors, '[]') as top_colors
 from (select cast(created_at as date) as trend_date, count(*) as total_photos,
   {big("sum(likes)")} as total_likes, {big("sum(downloads)")} as total_downloads,
   {big("sum(views)")} as total_views,
   {mean_decimal("sum(likes)", "count(*)")} as avg_likes_per_photo,
   {mean_decimal("sum(downloads)", "count(*)")} as avg_downloads_per_photo
  from stg group by 1) d
 left join nested_tags using (trend_date) left join nested_colors using (trend_date))
"""

TAG_ANALYSIS = f"""
tag_analysis as (
 select tag as tag_name, count(*) as photo_count, {big("sum(likes)")} as total_likes,
  {big("sum(downloads)")} as total_downloads,
  {mean_decimal("sum(likes)", "count(*)")} as avg_likes,
  {mean_decimal("sum(downloads)", "count(*)")} as avg_downloads,
  date '2001-08-01' as analysis_date
 from tagged group by tag)
"""

PHOTOGRAPHERS = f"""
photographer_analysis as (
 select user_id, username, full_name, total_photos, total_likes, total_downloads,
  avg_likes_per_photo, avg_downloads_per_photo, date '2001-08-01' as analysis_date
 from (select *, row_number() over (partition by user_id
    order by total_photos desc, username nulls first, full_name nulls first) as rn
  from (select user_id, user_username as username, user_name as full_name,
    count(*) as total_photos, {big("coalesce(sum(likes), 0)")} as total_likes,
    {big("coalesce(sum(downloads), 0)")} as total_downloads,
    {mean_decimal("coalesce(sum(likes), 0)", "count(*)")} as avg_likes_per_photo,
    {mean_decimal("coalesce(sum(downloads), 0)", "count(*)")} as avg_downloads_per_photo
   from photos where user_id is not null group by all)) where rn = 1)
"""

PAIRS = f"""
pair_rows as (
 select a.id, cast(a.created_at as date) as photo_date, a.tag as tag1, b.tag as tag2,
  a.likes, a.downloads, a.views
 from tagged a join photo_tags b on a.id = b.id and a.tag < b.tag),
pairs as (
 select tag1, tag2, count(distinct id) as cooccurrence_count,
  count(distinct photo_date) as days_appeared_together, {big("sum(likes)")} as total_likes,
  {big("sum(downloads)")} as total_downloads, {big("sum(views)")} as total_views,
  {mean2("sum(likes)", "count(*)")} as avg_likes,
  {mean2("sum(downloads)", "count(*)")} as avg_downloads,
  {mean2("sum(views)", "count(*)")} as avg_views,
  min(photo_date) as first_cooccurrence_date, max(photo_date) as latest_cooccurrence_date,
  date '2001-08-01' as analysis_date
 from pair_rows group by tag1, tag2),
paired as (
 select tag, count(distinct id) as n
 from (select tag1 as tag, id from pair_rows union all select tag2, id from pair_rows)
 group by tag),
rated as (
 select p.*, round(cast(cooccurrence_count as double) / n * 100, 2) as tag1_cooccurrence_rate
 from pairs p join paired on tag = tag1 where cooccurrence_count >= 2)
"""

RANKED = f"""
with {STG}, {PAIRS}
select *, row_number() over (order by cooccurrence_count desc, tag1, tag2) as popularity_rank,
 row_number() over (order by avg_likes desc, tag1, tag2) as engagement_rank from rated
"""

POSITIONAL = f"""
{PHOTO_TAGS},
pos_pairs as (
 select least(a.tag, b.tag) as tag1, greatest(a.tag, b.tag) as tag2,
  count(*) as cooccurrence_count, date '2001-08-01' as analysis_date
 from photo_tags a join photo_tags b on a.id = b.id and a.pos < b.pos
 group by 1, 2 having count(*) >= 2)
"""

# -- raw records ---------------------------------------------------------------------------

RAW = """
raw as (
 select o_orderkey as k, cast(o_orderkey as varchar) as id, c_custkey, c_name, c_mktsegment,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ||
   case o_orderkey % 3 when 0 then 'Z' when 1 then '+02:00' else '-05:30' end as created_at,
  o_orderdate - case o_orderkey % 3 when 0 then interval 0 minute when 1 then interval 120 minute
                else interval (-330) minute end as parsed,
  case when o_orderkey % 19 <> 0 then cast(1000 + o_orderkey * 37 % 3000 as int) end as width,
  cast(1000 + o_orderkey * 53 % 3000 as int) as height,
  '#' || lpad(upper(hex(o_orderkey * 7919 % 256)), 6, '0') as color,
  cast(floor(o_totalprice / 100) as bigint) as downloads,
  case when o_orderkey % 13 <> 0 then o_orderkey % 500 end as likes,
  cast(floor(o_totalprice / 10) as bigint) as views, o_orderpriority as description,
  case when o_orderkey % 17 <> 0 then lower(o_orderpriority) || ',' || lower(c_mktsegment) || ',' ||
   case when o_orderkey % 2 = 0 then lower(o_orderpriority) else lower(o_orderstatus) end
   else '' end as tags,
  case when o_orderkey % 17 <> 0 then 3 else 0 end as n_tags,
  o_orderkey % 23 = 0 as cut
 from orders join customer on o_custkey = c_custkey),
cut_lines as (
 select substr('{"id":"' || id || '","created_at":"' || created_at, 1, 30) as line, *
 from raw where cut)
"""

TRENDS = """
trends as (
 select event_type as search_term, cast(ts as date) as trend_date, count(*) as search_count,
  'trending' as category from events group by 1, 2, 4)
"""

STATISTICS = """
statistics as (
 select event_id as id, cast(user_id as varchar) as photo_id, ts as recorded_at,
  cast(floor(value) as bigint) as downloads, event_id as likes,
  coalesce(case when event_type <> 'error'
    then cast(json_extract_string(props, '$.k') as bigint) end, 0) as views from events)
"""

DELTAS = f"""
{STATISTICS},
deltas as (
 select *,
  downloads - coalesce(lag(downloads) over w, 0) as download_delta,
  likes - coalesce(lag(likes) over w, 0) as likes_delta,
  views - coalesce(lag(views) over w, 0) as views_delta
 from statistics window w as (partition by photo_id order by recorded_at, id))
"""

COUNTED = """
counted as (select l_orderkey, cast(sum(l_quantity) as bigint) as likes
            from lineitem group by l_orderkey)
"""

# stored rows that a batch of nine photos in ten leaves as they are
UNTOUCHED = """
select cast(o_orderkey as varchar), o_orderdate, 0, o_orderstatus, o_orderdate
from orders where o_orderkey % 10 = 3 and o_orderdate < timestamp '1999-01-01'
"""

TEXT_PHOTOS = """
text_photos as (
 select cast(doc_id as varchar) as id, text as description, lang as user_name,
  source as user_username, n_chars as likes, n_chars % 97 as downloads from documents)
"""

FOUND = """
found as (select * from text_photos where description ilike '%tHe%'
          or user_username ilike '%tHe%' or user_name ilike '%tHe%')
"""

NULL_COLUMNS = (
    "id", "created_at", "width", "height", "likes", "downloads", "views", "user_id",
    "user_username", "user_name", "color", "first_tag",
)
NULL_COUNTS = " union all ".join(
    f"select '{c}' as column_name, count(*) filter ({c} is null) as n, count(*) as total from t"
    for c in NULL_COLUMNS
)
WITH_FIRST_TAG = f"""
{PHOTOS}, {PHOTO_TAGS},
t as (select p.*, f.tag as first_tag from photos p
      left join photo_tags f on f.id = p.id and f.pos = 1),
nulls as ({NULL_COUNTS})
"""

ORACLE: dict[str, str] = {
    "ingest_photos": f"""
with {RAW}
select id, created_at, width, height, color, likes, views, description, c_name as username,
 case when n_tags = 3 then 5 end as raw_tags, null as corrupt from raw where not cut
union all
select null, null, null, null, null, null, null, null, null, null, line from cut_lines""",
    "ingest_search_results": f"""
with {RAW}
select (select count(*) from raw) as total,
 (select cast(ceil(count(*) / 20) as bigint) from raw) as total_pages,
 id, width, color, cast(c_custkey as varchar) as user_id, null as corrupt
from raw where (k // 20) % 7 <> 3
union all
select null, null, null, null, null, null, '{{"results":[{{"id":' from (
 select distinct k // 20 as page from raw) where page % 7 = 3""",
    "ingest_collections": """
select p_brand as id, cast(null as varchar) as title, min(p_name) as description,
 count(*) as total_photos from part group by p_brand""",
    "ingest_user_statistics": """
select cast(o_custkey as varchar) as id, count(*) as downloads,
 cast(sum(o_orderkey) as bigint) as views from orders group by o_custkey""",
    "enrich_details": """
with details as (
 select l_orderkey, min(l_returnflag) as description,
  cast(sum(cast(l_quantity as bigint)) as bigint) as likes from lineitem group by l_orderkey),
stats as (select user_id, max(event_id) as likes, count(*) as views from events group by user_id)
select cast(o_orderkey as varchar) as id,
 case when d.l_orderkey is not null then d.description else o_orderpriority end as description,
 d.likes, s.likes as stat_likes, s.views as stat_views
from orders left join details d on l_orderkey = o_orderkey left join stats s on user_id = o_orderkey
""",
    "normalize_photos": f"""
with {RAW}
select id, parsed as created_at, parsed as updated_at, width, height, color,
 cast(null as varchar) as blur_hash, downloads, likes, views, description,
 cast(c_custkey as varchar) as user_id, c_mktsegment as user_name, c_name as user_username, tags,
 0 as urls_size, 0 as location_size, 0 as exif_size, 0 as categories_size
from raw where width is not null""",
    "clean_tags": f"with {RAW} select id, tags, n_tags as n from raw",
    "parse_iso_ts": f"with {RAW} select id, created_at, parsed from raw",
    "skip_bad_records": f"""
with {RAW}
select id, case when width is null then 'width' end as reason from raw where not cut
union all select line, 'malformed' from cut_lines""",
    "upsert_photos": f"""
with {COUNTED}
select cast(o_orderkey as varchar) as id, o_orderdate + interval 1 day as updated_at, likes,
 o_orderpriority as description,
 case when o_orderdate < timestamp '1999-01-01' then o_orderdate
      else timestamp '2024-01-01' end as extracted_at
from orders left join counted on l_orderkey = o_orderkey where o_orderkey % 10 <> 3
union all {UNTOUCHED}""",
    "touch_updated_at": f"""
with {COUNTED}
select cast(o_orderkey as varchar) as id,
 case when o_orderdate < timestamp '1999-01-01' then timestamp '2024-01-02'
      else o_orderdate + interval 1 day end as updated_at, likes,
 o_orderpriority as description, timestamp '2024-01-01' as extracted_at
from orders left join counted on l_orderkey = o_orderkey where o_orderkey % 10 <> 3
union all {UNTOUCHED}""",
    "upsert_search_trends": f"""
with {TRENDS},
first as (select event_type as search_term, cast(ts as date) as trend_date,
  count(*) as search_count, 'trending' as category from events where value > 50 group by 1, 2, 4)
select * from trends where trend_date >= date '2024-01-15'
union all select * from first where trend_date < date '2024-01-15'""",
    "stat_deltas": f"with {DELTAS} select * from deltas",
    "stat_deltas_incremental": f"with {DELTAS} select * exclude (id) from deltas",
    "stat_deltas_late": f"with {DELTAS} select * exclude (id) from deltas",
    "upsert_analysis": f"""
with {STG}, {TAG_ANALYSIS},
words as (select p_size as likes, cast(floor(p_retailprice) as bigint) as downloads,
          unnest(string_split(p_name || ' ' || p_type, ' ')) as tag from part)
select tag as tag_name, count(*) as photo_count, {big("sum(likes)")} as total_likes,
 {big("sum(downloads)")} as total_downloads, {mean_decimal("sum(likes)", "count(*)")} as avg_likes,
 {mean_decimal("sum(downloads)", "count(*)")} as avg_downloads, date '2001-07-31' as analysis_date
from words group by tag
union all select * from tag_analysis
union all select 'old ' || tag_name, * exclude (tag_name) from tag_analysis""",
    "stg_photos": f"with {STG} select * from stg",
    "tag_metrics": f"""
with {STG}
select tag as tag_name, count(distinct id) as photo_count, {big("sum(likes)")} as total_likes,
 {big("sum(downloads)")} as total_downloads, {big("sum(views)")} as total_views,
 {mean2("sum(likes)", "count(*)")} as avg_likes,
 {mean2("sum(downloads)", "count(*)")} as avg_downloads,
 {mean2("sum(views)", "count(*)")} as avg_views,
 round(avg(case when views > 0 then cast(likes as double) / views * 100 else 0 end), 2)
  as avg_like_rate,
 round(avg(case when views > 0 then cast(downloads as double) / views * 100 else 0 end), 2)
  as avg_download_rate,
 count(distinct case when created_at >= date '2001-08-01' - interval 30 day then id end)
  as recent_photos_count,
 min(created_at) as first_photo_date, max(created_at) as latest_photo_date,
 date '2001-08-01' as analysis_date
from tagged group by tag having count(distinct id) >= 2""",
    "tag_analysis": f"with {STG}, {TAG_ANALYSIS} select * from tag_analysis",
    "photographer_metrics": f"""
with {STG}
select user_id, user_username, user_name, count(distinct id) as total_photos,
 {big("sum(likes)")} as total_likes, {big("sum(downloads)")} as total_downloads,
 {big("sum(views)")} as total_views,
 {mean2("sum(likes)", "count(*)")} as avg_likes_per_photo,
 {mean2("sum(downloads)", "count(*)")} as avg_downloads_per_photo,
 {mean2("sum(views)", "count(*)")} as avg_views_per_photo,
 round(avg(like_rate), 2) as avg_like_rate, round(avg(download_rate), 2) as avg_download_rate,
 round(avg(aspect_ratio), 2) as avg_aspect_ratio,
 mode() within group (order by orientation) as most_common_orientation,
 mode() within group (order by primary_tag) as most_common_tag,
 min(created_at) as first_photo_date, max(created_at) as latest_photo_date,
 count(distinct case when created_at >= date '2001-08-01' - interval 30 day then id end)
  as recent_photos_count,
 round((avg(likes) * 0.4::double + avg(downloads) * 0.6::double) /
  case when avg(views) > 0 then avg(views) else 1 end * 100, 2) as engagement_score,
 date '2001-08-01' as analysis_date
from stg where user_id is not null group by user_id, user_username, user_name""",
    "photographer_analysis": f"with {PHOTOS}, {PHOTOGRAPHERS} select * from photographer_analysis",
    "daily_stats": f"with {STG}, {DAILY_STATS} select * from daily_stats",
    "daily_top_tags": f"with {STG}, {DAILY_TAGS} select * from daily_tags",
    "daily_top_colors": f"with {STG}, {DAILY_TAGS} select * from daily_colors",
    "mart_daily_trends": MART_DAILY,
    "write_mart": MART_DAILY,
    "daily_trend_for_day": f"with {DAILY_TRENDS} select * from daily_trends",
    "tag_cooccurrence": f"""
with {STG}, {PAIRS} select * from pairs where cooccurrence_count >= 2""",
    "tag_pair_rate": f"""
with {STG}, {PAIRS}
select tag1, tag2, cooccurrence_count, tag1_cooccurrence_rate from rated""",
    "cooccurrence_ranks": RANKED,
    "cooccurrence_ranks_by_ranges": RANKED,
    "tag_pairs_positional": f"with {POSITIONAL} select * from pos_pairs",
    "co_occurring_tags": f"""
with {STG}, {PAIRS},
mirrored as (select tag1 as tag_name, tag2 as partner, cooccurrence_count from rated
             union all select tag2, tag1, cooccurrence_count from rated)
select * from (select *, cast(row_number() over (partition by tag_name
  order by cooccurrence_count desc, partner) as int) as position from mirrored) where position <= 5""",
    "favorite_tags": f"""
with {STG}
select * from (select *,
  cast(row_number() over (partition by user_id order by uses desc, tag) as int) as position from (select user_id, tag, count(*) as uses from tagged where user_id is not null group by all))
where position <= 5""",
    "photo_count": f"with {PHOTOS} select count(id) as total_photos from photos",
    "list_photos": f"""
with {RAW}, good as (select * from raw where width is not null)
select id, description, width, height, color, likes, downloads, views, parsed as created_at,
 cast(c_custkey as varchar) as user_id, c_name as username, c_mktsegment as name, tags,
 (select count(*) from good) as total, (select count(*) > 60 from good) as has_next
from good order by views desc, id limit 20 offset 40""",
    "list_photos_deep_page": f"""
with {RAW}
select id, views, likes, c_name as username from raw where width is not null
order by views desc, id limit 50 offset 700""",
    "photo_detail": f"""
with {PHOTOS}, {STATISTICS},
last as (select *, row_number() over (partition by photo_id order by recorded_at desc, id desc) as rn
         from statistics)
select p.id, width, height, color, p.likes, p.views, created_at, user_username as username,
 s.likes as latest_likes, s.downloads as latest_downloads,
 case when s.id in (select event_id from events where event_type <> 'error') then s.views end
  as latest_views, recorded_at
from photos p left join last s on photo_id = p.id and rn = 1""",
    "recent_search_trends": f"""
with {TRENDS}
select search_term, search_count, trend_date, category from trends
where trend_date >= date '2024-01-23'
order by search_count desc, search_term, trend_date limit 20""",
    "top_tags": f"""
with {STG}, {TAG_ANALYSIS}
select * from tag_analysis order by total_likes desc, tag_name limit 20""",
    "top_photographers": f"""
with {PHOTOS}, {PHOTOGRAPHERS}
select * from photographer_analysis order by avg_likes_per_photo desc, user_id limit 20""",
    "recent_daily_trends": f"""
with {DAILY_TRENDS} select * from daily_trends where trend_date >= date '2001-07-02'""",
    "top_tag_pairs": f"""
with {POSITIONAL}
select * from pos_pairs order by cooccurrence_count desc, tag1, tag2 limit 50""",
    "overview_stats": f"""
with {PHOTOS},
top as (select * from photos order by coalesce(likes, 0) desc, id limit 1),
jobs as (
 select event_type || '-' || cast(event_id as varchar) as job_name,
  case when event_type = 'error' then 'failed' else 'completed' end as status, ts as started_at,
  case when event_type <> 'error' then ts end as completed_at,
  cast(json_extract_string(props, '$.k') as bigint) as records_processed
 from events order by ts desc, 1 limit 1)
select (select count(id) from photos) as total_photos,
 (select count(distinct user_id) from photos) as total_photographers,
 (select count(*) from photos where cast(created_at as date) >= date '2001-07-25')
  as recent_photos_7_days,
 (select id from top) as top_id, (select likes from top) as top_likes,
 (select user_username from top) as top_username, jobs.* from jobs""",
    "search_photos": f"""
with {TEXT_PHOTOS}, {FOUND}
select id, md5(description) as description_md5, likes, downloads, user_username as username,
 user_name as name, (select count(*) from found) as total,
 (select count(*) > 25 from found) as has_next
from found order by likes desc, id limit 20 offset 5""",
    "histogram": f"""
with {PHOTOS}, x as (select cast(coalesce(likes, 0) as double) as x from photos),
bounds as (select min(x) as low, max(x) as high from x),
counts as (select cast(case when high > low then least(floor((x - low) / ((high - low) / 20)), 19)
                       else 0 end as bigint) as bin, count(*) as n from x, bounds group by 1)
select range as bin, low + range * ((high - low) / 20) as bin_start, coalesce(n, 0) as photos
from range(20), bounds left join counts on bin = range""",
    "histogram_of_page": f"""
with {PHOTOS}, page as (select coalesce(likes, 0) as likes, id from photos
 order by 1 desc, id limit 50),
x as (select cast(likes as double) as x from page),
bounds as (select min(x) as low, max(x) as high from x),
counts as (select cast(case when high > low then least(floor((x - low) / ((high - low) / 20)), 19)
                       else 0 end as bigint) as bin, count(*) as n from x, bounds group by 1)
select range as bin, low + range * ((high - low) / 20) as bin_start, coalesce(n, 0) as photos
from range(20), bounds left join counts on bin = range""",
    "color_counts": f"""
with {PHOTOS} select color, count(*) as photos from photos where color is not null
group by color order by photos desc, color limit 10""",
    "top_photos_table": f"""
with {TEXT_PHOTOS}
select case when length(description) > 50 then substr(description, 1, 50) || '...'
            else description end as description, likes, downloads, user_username as photographer
from text_photos order by likes desc, id limit 10""",
    "nlargest_tags": f"""
with {STG}, {TAG_ANALYSIS},
page as (select * from tag_analysis order by total_likes desc, tag_name limit 20)
select * from page order by avg_downloads desc, tag_name limit 10""",
    "tag_pair_labels": f"""
with {POSITIONAL}
select tag1 || ' + ' || tag2 as tag_pair, cooccurrence_count from pos_pairs
order by cooccurrence_count desc, tag1, tag2 limit 15""",
    "daily_search_activity": f"""
with {TRENDS} select trend_date, {big("sum(search_count)")} as search_count from trends
group by trend_date""",
    "data_freshness": """
select table_name, newest, cast(date '2024-01-30' - cast(newest as date) as int) as lag_days from (
 select 'photos' as table_name, max(o_orderdate) as newest from orders
 union all select 'photo_tags', max(l_shipdate) from lineitem
 union all select 'photo_statistics', max(ts) from events)""",
    "data_completeness": f"""
with {WITH_FIRST_TAG}
select column_name, n as null_count, cast(n as double) / total as null_share from nulls""",
    "dedup_latest": """
select event_id as id, cast(user_id as varchar) as email, ts as updated_at, event_type as full_name
from (select *, row_number() over (partition by user_id order by ts desc, event_id) as rn
      from events) where rn = 1""",
    "dedup_log": """
select 'duplicate_user_cleanup' as operation,
 'Cleaned up duplicate users for email ' || cast(user_id as varchar) || '. Kept ID: ' ||
 cast(ids[1] as varchar) || ', Removed IDs: ' || array_to_string(ids[2:], ', ') as details,
 len(ids) - 1 as affected_records
from (select user_id, list(event_id order by ts desc, event_id) as ids from events group by user_id)
where len(ids) > 1""",
    "dedup_removed": """
select 'duplicate_user_cleanup' as operation, email, kept_id, event_id as removed_id from (
 select cast(user_id as varchar) as email, event_id,
  first_value(event_id) over w as kept_id, row_number() over w as rn
 from events window w as (partition by user_id order by ts desc, event_id)) where rn > 1""",
    "dedup_counts": """
select 'duplicate_user_cleanup' as operation, cast(user_id as varchar) as email,
 arg_min(event_id, (-epoch_us(ts), event_id)) as kept_id, count(*) - 1 as affected_records
from events group by user_id having count(*) > 1""",
    "cleanup_summary": """
select event_type as operation, count(*) as total_runs,
 cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total_records_affected,
 min(ts) as first_run, max(ts) as last_run from events group by event_type""",
    "row_filter": f"""
with {TEXT_PHOTOS}
select id, user_name, user_username, likes, md5(description) as description_md5
from text_photos where user_username = 'src1'""",
    "check_unique": """
select l_orderkey, l_linenumber, count(*) as "rows" from lineitem group by 1, 2
having count(*) > 1""",
    "check_not_null": f"""
with {WITH_FIRST_TAG} select column_name, n as "rows" from nulls where n > 0""",
    "check_foreign_key": f"""
with {PHOTOS}
select id, count(*) as "rows" from photos
where id not in (select cast(user_id as varchar) from events) group by id""",
    "check_foreign_key_statistics": f"""
with {PHOTOS}
select cast(user_id as varchar) as photo_id, count(*) as "rows" from events
where cast(user_id as varchar) not in (select id from photos where views > 0) group by 1""",
    "store_failures": """
select 'unique_lines' as check_name, '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' ||
 l_linenumber || ',"rows":' || count(*) || '}' as failing
from lineitem group by l_orderkey, l_linenumber having count(*) > 1
union all
select 'orders_without_lines',
 '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' from orders
where o_orderkey not in (select l_orderkey from lineitem)""",
    "evolve_schema": f"""
with {STG}, {TAG_ANALYSIS}
select *, cast(null as double) as trend_score, timestamp '2001-08-01' as updated_at,
 cast(null as varchar) as co_occurring_tags from tag_analysis""",
    "elt_run": f"""
with {RAW},
good as (select * from raw where width is not null and not cut),
tags as (select distinct unnest(string_split(tags, ',')) as tag from good where tags <> '')
select 'extract' as phase, 'extract_photos' as step, true as success, count(*) as records,
 cast(null as varchar) as error from raw
union all select 'load', 'load_photos', true, count(*), null from good
union all select 'load', 'load_trending_data', true,
 count(distinct event_type || cast(cast(ts as date) as varchar)), null from events
union all select 'transform', 'analyze_tags', true, count(*), null from tags
union all select 'transform', 'analyze_photographers', true, count(distinct c_custkey), null
 from good
union all select 'transform', 'generate_daily_trends', true,
 least(count(*), 1), null from good where cast(parsed as date) = date '2001-08-01'
union all select 'transform', 'build_marts', true, 5, null
union all select 'transform', 'test_tables', true, 0, null""",
    "tag_analysis_table": f"""
with {RAW}, good as (select * from raw where width is not null and not cut and n_tags > 0)
select tag as tag_name, count(*) as photo_count, {big("sum(coalesce(likes, 0))")} as total_likes,
 {mean_decimal("sum(coalesce(likes, 0))", "count(*)")} as avg_likes,
 date '2001-08-01' as analysis_date, true as updated, cast(null as double) as trend_score,
 cast(null as varchar) as co_occurring_tags
from (select likes, unnest(string_split(tags, ',')) as tag from good) group by tag""",
    "photos_after_two_loads": f"""
with {RAW}
select id, parsed as created_at, width, case when k % 2 = 0 then likes + 1 else likes end as likes,
 timestamp '2024-01-31' as extracted_at, tags from raw where width is not null""",
    "quarantine": f"""
with {RAW}, bad as (select id, cut, case when cut then line end as line
 from raw left join (select id, line from cut_lines) using (id) where cut or width is null)
select 'photos' as feed, case when cut then 'malformed' else 'width' end as reason,
 date '2024-01-31' as recorded_on, count(case when not cut then id end) as ids,
 count(distinct line) as texts, count(*) as lines from bad group by cut
union all
select 'searches', case when event_id % 50 = 0 then 'malformed' else 'search_term,searched_at' end,
 date '2024-01-31', 0, count(distinct case when event_id % 50 = 0 then event_id end),
 count(*) from events where event_id % 50 = 0 or event_id % 51 = 0 group by 2""",
    "ingest_photo_batch": f"""
with {RAW}
select id, null as _corrupt, null as reason from (
 select * from raw where width is not null and not cut order by parsed desc, id limit 100)
union all select id, null, 'width' from raw where width is null and not cut
union all select null, line, 'malformed' from cut_lines""",
    "job_log": f"""
with {RAW},
done as (
 select 'load_photos' as job_name, count(*) as n from raw where width is not null and not cut
 union all select 'load_trending_data',
  count(distinct event_type || cast(cast(ts as date) as varchar)) from events)
select job_name, 'load' as job_type, 'running' as status, 0 as records_processed,
 cast(null as varchar) as error_message, false as ended from done
union all select job_name, 'load', 'completed', n, null, true from done""",
    "stream_upsert_photos": f"""
with {RAW}
select id, parsed as created_at, width, height, color, likes, views,
 cast(c_custkey as varchar) as user_id, tags from raw where width is not null and not cut""",
}

# the same rows by other ways: from cells that loads have filled and changed, with pairs left out
# beforehand, from a page found by counting, an index, a stored table
ORACLE |= {
    "list_photos_selected": ORACLE["list_photos_deep_page"],
    "search_photos_indexed": ORACLE["search_photos"],
    "dedup_applied": ORACLE["dedup_latest"],
    "tag_metrics_incremental": ORACLE["tag_metrics"],
    "tag_pairs_positional_incremental": ORACLE["tag_pairs_positional"],
    "tag_pair_rate_incremental": f"""
with {STG}, {PAIRS}
select p.*, r.tag1_cooccurrence_rate from pairs p join rated r
 on p.tag1 = r.tag1 and p.tag2 = r.tag2 where p.cooccurrence_count >= 2""",
    "tag_cooccurrence_pruned": f"""
with {STG}, {PAIRS} select * from pairs where cooccurrence_count >= 5""",
}
