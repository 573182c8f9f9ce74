import datetime as dt

import pytest

from conftest import rows
from shutterlake.operators import daily, photographers, tags
from shutterlake.operators.staging import stg_photos

AS_OF = dt.date(2024, 12, 20)


def ago(days):
    return dt.datetime(2024, 12, 20) - dt.timedelta(days=days)


@pytest.fixture(scope="module")
def samples(make_photos):
    def sample(n, days, w, h, color, downloads, likes, views, user, words):
        return {
            "id": f"sample_00{n}", "created_at": ago(days), "width": w, "height": h,
            "color": color, "downloads": downloads, "likes": likes, "views": views,
            "user_id": f"user_00{n}", "user_username": user, "user_name": user.title(),
            "tags": words.split(","),
        }

    return make_photos(
        sample(1, 5, 3000, 2000, "#FF5733", 1250, 89, 5420, "johnphoto",
               "sunset,mountains,landscape,nature,orange,sky"),
        sample(2, 3, 2400, 3600, "#2E8B57", 890, 156, 3240, "sarahstreet",
               "street,urban,city,people,black and white,photography"),
        sample(3, 1, 4000, 2667, "#4169E1", 2100, 234, 8750, "alexarch",
               "architecture,minimalist,modern,building,geometric,blue"),
    )


def test_samples(samples):
    got = {r["id"]: r for r in stg_photos(samples, AS_OF).collect()}
    one, two, three = (got[f"sample_00{n}"] for n in (1, 2, 3))
    assert one["aspect_ratio"] == 1.5 and one["orientation"] == "landscape"
    assert two["orientation"] == "portrait"
    assert three["aspect_ratio"] == pytest.approx(4000 / 2667)
    assert one["like_rate"] == pytest.approx(89 / 5420 * 100)
    assert two["download_rate"] == pytest.approx(890 / 3240 * 100)
    assert three["download_rate"] == 24.0
    assert [r["primary_tag"] for r in (one, two, three)] == ["sunset", "street", "architecture"]
    assert [r["days_since_created"] for r in (one, two, three)] == [5, 3, 1]


def test_sample_scores(samples):
    stg = stg_photos(samples, AS_OF)
    got = rows(photographers.photographer_metrics(stg, AS_OF), "user_id", "engagement_score")
    assert got == [("user_001", 14.49), ("user_002", 18.41), ("user_003", 15.47)]


def test_sample_tags(samples):
    bags = tags.photo_bags(samples)
    assert tags.tag_metrics(bags, AS_OF).count() == 0
    assert tags.tag_analysis(bags, AS_OF).count() == 18


def test_edges(make_photos):
    photos = make_photos(
        {"id": "flat", "width": 5, "height": 0, "likes": 3, "views": 0, "tags": []},
        {"id": "unknown", "height": 5, "likes": 3, "tags": None},
        {"id": "no likes", "width": 2, "height": 2, "views": 10, "tags": ["a"]},
    )
    got = {r["id"]: r for r in stg_photos(photos, AS_OF).collect()}
    assert got["flat"]["aspect_ratio"] is None and got["flat"]["orientation"] == "landscape"
    assert got["flat"]["like_rate"] == 0.0 and got["flat"]["primary_tag"] is None
    assert got["unknown"]["orientation"] == "square" and got["unknown"]["like_rate"] == 0.0
    assert got["unknown"]["views"] == 0 and got["unknown"]["primary_tag"] is None
    assert got["no likes"]["like_rate"] is None and got["no likes"]["likes"] == 0
    assert got["no likes"]["download_rate"] is None


def test_photographer_modes_and_names(make_photos):
    def photo(n, w, h, words, name="x", likes=1):
        return {"id": str(n), "created_at": ago(n), "width": w, "height": h, "tags": words,
                "user_id": "u", "user_username": name, "user_name": "n", "likes": likes}

    photos = make_photos(
        photo(0, 2, 1, ["b"]), photo(1, 1, 2, ["a"]), photo(30, 1, 2, None), photo(31, 2, 1, []),
    )
    got = photographers.photographer_metrics(stg_photos(photos, AS_OF), AS_OF).first()
    assert got["most_common_orientation"] == "landscape"
    assert got["most_common_tag"] == "a"
    assert got["recent_photos_count"] == 3  # exactly 30 days ago counts
    assert got["engagement_score"] == 40.0  # no views: divided by 1
    renamed = make_photos(photo(0, 1, 1, [], "new"), photo(1, 1, 1, [], "old", 8),
                          photo(2, 1, 1, [], "old", None))
    got = photographers.photographer_analysis(renamed, AS_OF).collect()
    assert [(r["username"], r["total_photos"], r["total_likes"]) for r in got] == [("old", 2, 8)]
    assert str(got[0]["avg_likes_per_photo"]) == "4.00"


def test_untagged_photographer(make_photos):
    photos = make_photos({"id": "1", "created_at": ago(1), "user_id": "u", "tags": []})
    got = photographers.photographer_metrics(stg_photos(photos, AS_OF), AS_OF).first()
    assert got["most_common_tag"] is None and got["total_photos"] == 1


def test_daily(make_photos):
    photos = make_photos(
        *[{"id": f"{i}-{j}", "created_at": ago(1), "tags": [f"t{i:02}"], "color": "c", "likes": 1}
          for i in range(11) for j in range(2)],
        {"id": "x", "created_at": ago(2), "tags": None},
    )
    bags = tags.photo_bags(photos)
    one = daily.daily_trends(photos, bags, ago(1).date()).collect()
    assert len(one) == 1 and one[0]["total_photos"] == 22
    assert [t["tag"] for t in one[0]["top_tags"]] == [f"t{i:02}" for i in range(10)]
    assert [tuple(c) for c in one[0]["top_colors"]] == [("c", 22)]
    assert daily.daily_trends(photos, bags, ago(3).date()).count() == 0
    untagged = daily.daily_trends(photos, bags, ago(2).date()).first()
    assert untagged["top_tags"] == [] and untagged["total_likes"] == 0
    mart = daily.mart_daily_trends(stg_photos(photos, AS_OF), bags).collect()
    assert [r["trend_date"] for r in mart] == [ago(1).date(), ago(2).date()]
    assert mart[1]["top_tags"] is None
