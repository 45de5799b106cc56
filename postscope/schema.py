"""Fixed schemas of the post data model.

Reading with an explicit schema avoids an inference pass over the input and
lets Catalyst prune nested fields per question (``ReadSchema`` only lists
what the plan touches).
"""

from pyspark.sql import types as T

USER = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("username", T.StringType(), True),
    ]
)

MENTION = T.StructType([T.StructField("username", T.StringType(), True)])

POST = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("date", T.StringType(), True),
        T.StructField("content", T.StringType(), True),
        T.StructField("user", USER, True),
        T.StructField("mentionedUsers", T.ArrayType(MENTION, True), True),
    ]
)

POST_DDL = (
    "id BIGINT, date STRING, content STRING, "
    "user STRUCT<id: BIGINT, username: STRING>, "
    "mentionedUsers ARRAY<STRUCT<username: STRING>>"
)

CORRUPT_COLUMN = "_corrupt_record"

# Fields each question needs in strict mode (a post missing one of them is
# rejected for that question only). For q3 the list may be null, but no
# element may lack its name (see ``sources.posts.valid_for``).
REQUIRED_FIELDS = {
    "q1": ("date", "user.username"),
    "q2": ("content",),
    "q3": ("mentionedUsers",),
}
