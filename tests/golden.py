"""The golden edge-case fixture: ten feed rows over three country files and a dictionary.

Each row carries one or more edge cases (see FIXTURES.md):

v1 CA   ratio exactly 6 -> neutral; a repeated tag differing in case
v2      6.1 -> good; '[none]' only
v3      3.9 -> bad; two trailing empty tags
v1 GB   ratio exactly 4 -> neutral; the same video id again (kept)
v4      dislikes '0' counts as 1 -> 7 -> good; unknown category id 99
v5      0/0 becomes 0/1 -> bad; comma and '#' inside tags
v6      comment_count NULL (still in the divisor); id 34 shares a name with 23
v7, v8  disabled flags: out of the classification, still in the top tags
v9      unparsable dislikes: no class; '[NONE]' is not '[none]'
"""

from __future__ import annotations

import csv
import io
import json
import os

from feedlens.schema import FEED_COLUMNS

ROWS = [
    # region, video_id, trending_date, category_id, tags, views, likes, dislikes, comment_count, c_dis, r_dis
    ("CA", "v1", "18.14.11", "10", "Rock|Live|rock", "100", "60", "10", "4", "False", "False"),
    ("CA", "v2", "18.14.11", "10", "[none]", "100", "61", "10", "6", "False", "False"),
    ("CA", "v3", "18.14.11", "24", "Show||", "100", "39", "10", "2", "False", "False"),
    ("GB", "v1", "18.13.11", "10", "rock|pop", "100", "40", "10", "8", "False", "False"),
    ("GB", "v4", "18.13.11", "99", "lost|pop", "100", "7", "0", "5", "False", "False"),
    ("GB", "v5", "18.13.11", "23", "a,b|#tag", "100", "0", "0", "0", "False", "False"),
    ("US", "v6", "18.12.11", "34", "A,B", "100", "5", "1", None, "False", "False"),
    ("US", "v7", "18.12.11", "10", "rock", "100", "100", "1", "9", "True", "False"),
    ("US", "v8", "18.12.11", "24", "[none]", "100", "0", "0", "3", "False", "True"),
    ("US", "v9", "18.12.11", "24", "[NONE]", "100", "50", "n/a", "1", "False", "False"),
]

DICTIONARY = [
    ("1", "Film & Animation"),
    ("10", "Music"),
    ("23", "Comedy"),
    ("24", "Entertainment"),
    ("34", "Comedy"),
]


def feed_records():
    """Dicts with all sixteen feed columns (region kept separately)."""
    out = []
    for region, vid, date, cat, tags, views, likes, dislikes, comments, c_dis, r_dis in ROWS:
        rec = {c: None for c in FEED_COLUMNS}
        rec.update(
            video_id=vid,
            trending_date=date,
            title=f"title {vid}",
            channel_title=f"channel {region}",
            category_id=cat,
            publish_time="2018-11-13T17:00:00.000Z",
            tags=tags,
            views=views,
            likes=likes,
            dislikes=dislikes,
            comment_count=comments,
            thumbnail_link=f"thumb/{vid}.jpg",
            comments_disabled=c_dis,
            ratings_disabled=r_dis,
            video_error_or_removed="False",
            description=f"about {vid}",
        )
        out.append((region, rec))
    return out


def write_feeds(root: str) -> list[str]:
    """One CSV file per country, RFC 4180 quoting, header line first."""
    paths = []
    for region in ("CA", "GB", "US"):
        buf = io.StringIO()
        w = csv.writer(buf, lineterminator="\n")
        w.writerow(FEED_COLUMNS)
        for r, rec in feed_records():
            if r == region:
                w.writerow(["" if rec[c] is None else rec[c] for c in FEED_COLUMNS])
        d = os.path.join(root, f"{region}videos")
        os.makedirs(d, exist_ok=True)
        p = os.path.join(d, f"{region}videos.csv")
        with open(p, "w", encoding="utf-8") as f:
            f.write(buf.getvalue())
        paths.append(p)
    return paths


def write_dictionary(root: str) -> str:
    p = os.path.join(root, "category_id_flat.json")
    with open(p, "w", encoding="utf-8") as f:
        for i, name in DICTIONARY:
            f.write(json.dumps({"id": i, "category": name}) + "\n")
    return p
