"""Explicit schemas for the raw JSON payloads and the processed tables.

Raw payloads are never inferred: an inferred schema changes with the data (a
field missing from every item becomes unresolvable, ``items: []`` infers
``array<string>``), and inference costs a full extra pass over the input.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TS, DT = T.TimestampType(), T.DateType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


# ---- raw payloads: {"items": [...]} one pretty-printed object per file ----

CHANNEL_RAW = _struct(
    items=T.ArrayType(
        _struct(
            id=S,
            snippet=_struct(title=S, description=S, customUrl=S, publishedAt=S, country=S),
            statistics=_struct(viewCount=S, subscriberCount=S, videoCount=S),
            contentDetails=_struct(relatedPlaylists=_struct(uploads=S)),
        )
    )
)

VIDEO_RAW = _struct(
    items=T.ArrayType(
        _struct(
            id=S,
            snippet=_struct(
                channelId=S, title=S, description=S, publishedAt=S,
                channelTitle=S, categoryId=S, tags=T.ArrayType(S),
            ),
            contentDetails=_struct(duration=S),
            statistics=_struct(viewCount=S, likeCount=S, favoriteCount=S, commentCount=S),
        )
    )
)

COMMENT_RAW = _struct(
    items=T.ArrayType(
        _struct(
            id=S,
            snippet=_struct(
                topLevelComment=_struct(
                    snippet=_struct(
                        authorDisplayName=S,
                        authorChannelId=_struct(value=S),
                        textDisplay=S,
                        publishedAt=S,
                        updatedAt=S,
                        likeCount=S,
                    )
                )
            ),
        )
    )
)

PLAYLIST_RAW = _struct(items=T.ArrayType(_struct(contentDetails=_struct(videoId=S))))

# ---- processed tables ----

CHANNEL = _struct(
    channel_id=S, channel_title=S, channel_description=S, custom_url=S,
    published_at=TS, country=S, view_count=L, subscriber_count=L, video_count=I,
    uploads_playlist_id=S,
)

VIDEO = _struct(
    video_id=S, channel_id=S, title=S, description=S, published_at=TS,
    channel_title=S, category_id=S, tags=T.ArrayType(S), duration=S,
    view_count=L, like_count=L, favorite_count=L, comment_count=L,
    duration_seconds=I, category_name=S, engagement_rate=D, publish_date=DT,
    days_since_published=I,
)

COMMENT = _struct(
    comment_id=S, video_id=S, author_name=S, author_channel_id=S, text=S,
    published_at=TS, updated_at=TS, like_count=I,
)

PLAYLIST_ITEM = _struct(playlist_id=S, video_id=S)
