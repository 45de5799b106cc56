import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from postscope.session import get_session

    s = get_session("local[4]", 4)
    yield s


@pytest.fixture
def write_posts(tmp_path):
    """Write rows (dicts or raw strings) as an NDJSON file; return its path."""
    counter = {"n": 0}

    def _write(rows, name=None):
        counter["n"] += 1
        p = tmp_path / (name or f"posts{counter['n']}.json")
        with open(p, "w", encoding="utf-8") as f:
            for r in rows:
                f.write((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n")
        return str(p)

    return _write


def post(date=None, username=None, content=None, mentions=None, uid=None, pid=None):
    d = {}
    if pid is not None:
        d["id"] = pid
    if date is not None:
        d["date"] = date
    if content is not None:
        d["content"] = content
    if username is not None or uid is not None:
        d["user"] = {"id": uid, "username": username}
    if mentions is not None:
        d["mentionedUsers"] = None if mentions == "null" else [{"username": m} for m in mentions]
    return d


@pytest.fixture
def posts_df(spark):
    """Build a posts DataFrame (schema POST) from dicts, without files."""
    from postscope.schema import POST

    def _df(rows):
        lines = [json.dumps(r, ensure_ascii=False) for r in rows]
        from pyspark.sql import functions as F

        return spark.createDataFrame([(x,) for x in lines], "value string").select(
            F.from_json("value", POST).alias("p")
        ).select("p.*")

    return _df
