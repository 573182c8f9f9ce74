"""Table schemas. Floats are doubles, counters bigint, averages decimal(10,2)."""

from __future__ import annotations

RAW_PHOTO = """
    id string, created_at string, updated_at string, width int, height int, color string,
    blur_hash string, downloads bigint, likes bigint, views bigint, description string,
    alt_description string, urls map<string,string>, links map<string,string>,
    user struct<id:string,name:string,username:string>, location map<string,string>,
    exif map<string,string>, tags array<struct<title:string>>, categories array<string>,
    statistics struct<downloads:struct<total:bigint>,likes:struct<total:bigint>,
    views:struct<total:bigint>>
"""

RAW_STATISTICS = """
    id string, downloads struct<total:bigint>, likes struct<total:bigint>,
    views struct<total:bigint>
"""

RAW_COLLECTION = """
    id string, title string, description string, published_at string, updated_at string,
    total_photos bigint, user struct<id:string,name:string,username:string>,
    tags array<struct<title:string>>
"""

RAW_USER_STATISTICS = """
    id string, username string, downloads struct<total:bigint>, views struct<total:bigint>
"""

PHOTOS = """
    id string, created_at timestamp, updated_at timestamp, width int, height int,
    color string, blur_hash string, downloads bigint, likes bigint, views bigint,
    description string, alt_description string, urls map<string,string>,
    links map<string,string>, user_id string, user_name string, user_username string,
    location map<string,string>, exif map<string,string>, tags array<string>,
    categories array<string>, extracted_at timestamp
"""

PHOTO_STATISTICS = """
    photo_id string, recorded_at timestamp, downloads bigint, likes bigint, views bigint,
    download_delta bigint, likes_delta bigint, views_delta bigint
"""

# The newest snapshot of each photo.
PHOTO_LAST_STATISTICS = """
    photo_id string, recorded_at timestamp, downloads bigint, likes bigint, views bigint
"""

# The days of a month on which a photo has snapshots, one bit each.
PHOTO_STATISTICS_DAYS = """
    photo_id string, month date, days int
"""

# Records of any feed that could not be loaded.
QUARANTINE = """
    feed string, id string, _corrupt string, reason string, fingerprint bigint,
    recorded_on date, lines bigint
"""

SEARCH_TRENDS = """
    search_term string, search_count bigint, trend_date date, category string,
    extracted_at timestamp
"""

TAG_ANALYSIS = """
    tag_name string, photo_count bigint, total_likes bigint, total_downloads bigint,
    avg_likes decimal(10,2), avg_downloads decimal(10,2), analysis_date date,
    trend_score double, updated_at timestamp, co_occurring_tags array<string>
"""

TAG_COOCCURRENCE = """
    tag1 string, tag2 string, cooccurrence_count bigint, analysis_date date
"""

PHOTOGRAPHER_ANALYSIS = """
    user_id string, username string, full_name string, total_photos bigint,
    total_likes bigint, total_downloads bigint, avg_likes_per_photo decimal(10,2),
    avg_downloads_per_photo decimal(10,2), follower_count bigint, analysis_date date,
    favorite_tags array<string>, style_analysis string, updated_at timestamp
"""

DAILY_TRENDS = """
    trend_date date, total_photos bigint, total_likes bigint, total_downloads bigint,
    total_views bigint, avg_likes_per_photo decimal(10,2),
    avg_downloads_per_photo decimal(10,2), top_tags array<struct<tag:string,count:bigint>>,
    top_colors array<struct<color:string,count:bigint>>, created_at timestamp
"""

ETL_JOBS = """
    job_name string, job_type string, status string, started_at timestamp,
    completed_at timestamp, records_processed bigint, error_message string,
    meta_data map<string,string>
"""

CLEANUP_LOGS = """
    operation string, details string, affected_records bigint, created_at timestamp
"""

# Key columns of each table, used by upserts and by the uniqueness check.
KEYS = {
    "photos": ["id"],
    "photo_statistics": ["photo_id", "recorded_at"],
    "search_trends": ["search_term", "trend_date"],
    "tag_analysis": ["tag_name", "analysis_date"],
    "tag_cooccurrence": ["tag1", "tag2", "analysis_date"],
    "photographer_analysis": ["user_id", "analysis_date"],
    "daily_trends": ["trend_date"],
    "users": ["email"],
}

# Columns that must not be null.
REQUIRED = {
    "photos": ["id", "created_at", "updated_at", "width", "height"],
    "search_trends": ["search_term", "trend_date"],
    "tag_analysis": ["tag_name", "analysis_date"],
}
