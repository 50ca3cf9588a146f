"""Schemas of the landed payloads and of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*fields: tuple[str, str, bool]) -> T.StructType:
    schema = T.StructType()
    for name, kind, required in fields:
        schema.add(name, kind, not required)
    return schema


def _required(kind: str, *names: str) -> tuple[tuple[str, str, bool], ...]:
    return tuple((name, kind, True) for name in names)


def _optional(kind: str, *names: str) -> tuple[tuple[str, str, bool], ...]:
    return tuple((name, kind, False) for name in names)


# typed view of one attendee payload; `data` holds [question, answer] pairs
PAYLOAD = (
    "id bigint, ticket_id bigint, ticket_name string, reg_no bigint, state string, "
    "checkin_code string, qrcode string, is_paid boolean, price double, currency string, "
    "payment_method string, data array<array<string>>, kyc map<string,string>, "
    "id_number string, updated_at double, ticket_type string, slot map<string,string>, "
    "order_no bigint"
)
PAYLOAD_FIELDS = tuple(part.split()[0] for part in PAYLOAD.split(", "))

TICKET_ORDERS = _table(
    ("id", "long", True),
    ("name", "string", True),
    ("attendee_info", "string", True),
    ("refunded", "boolean", True),
)

# the raw table as it is stored: times and ids as columns, folders by year and ticket groups
RAW_ORDERS = _table(
    ("id", "long", True),
    ("name", "string", True),
    ("attendee_info", "string", True),
    ("refunded", "boolean", True),
    ("attendee_id", "long", False),
    ("updated_at", "double", False),
    ("year", "integer", True),
    ("ticket_groups", "string", True),
)
RAW_PARTITIONS = ("year", "ticket_groups")

REJECTED_ORDERS = _table(
    ("id", "long", False),
    ("name", "string", False),
    ("attendee_info", "string", False),
    ("reason", "string", True),
)

USER_PROFILE = _table(
    ("year", "long", False),
    *_optional(
        "string",
        "email",
        "organization",
        "job_title",
        "country_or_region",
        "age_range",
        "gender",
    ),
    ("update_time", "timestamp", False),
)


# the table as it is stored: folders by a hash of year and email
USER_PROFILE_BY_PART = T.StructType([*USER_PROFILE, T.StructField("part", T.IntegerType())])


def label_updates(task: str) -> T.StructType:
    return _table((task, "string", False), ("category", "long", False))


POSTS = _table(
    ("id", "string", True), ("created_at", "timestamp", True), ("message", "string", True)
)

POST_INSIGHTS = _table(
    ("post_id", "string", True),
    ("query_time", "timestamp", True),
    ("period", "string", True),
    *_optional("long", "favorite", "reply", "retweet", "views"),
)

FEED_INSIGHTS = _table(
    ("post_id", "string", True),
    ("query_time", "timestamp", True),
    *_optional("long", "comments", "reactions", "share"),
)

VIDEO_STATISTICS = _table(
    ("created_at", "timestamp", True),
    *_required("string", "videoId", "title"),
    *_required("long", "viewCount", "likeCount", "dislikeCount", "favoriteCount", "commentCount"),
)

VIDEO_INFO = _table(
    ("created_at", "timestamp", True),
    *_required("string", "videoId", "title", "image_url", "subtitle"),
    ("time", "timestamp", True),
    ("url", "string", True),
)

VIDEO_ASIDE = _table(
    ("created_at", "timestamp", True),
    ("videoId", "string", True),
    ("title", "string", False),
    ("reason", "string", True),
)

FINANCE = _table(
    *_required(
        "string", "Reason", "Price", "Remarks", "Team_name", "Details", "To_who", "Yes_or_No"
    )
)

SURVEY_FACT = _table(
    ("ip", "string", False),
    ("question_id", "long", False),
    ("answer", "string", False),
    ("year", "long", False),
)

SURVEY_QUESTION = _table(
    ("question_id", "long", False), ("question", "string", False), ("year", "long", False)
)

NEWEST_TWEET = _table(("rest_id", "string", False))
