"""One small local session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadloom.session import build_session  # noqa: E402

KEYS = ["file_name", "post_pos"]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "threadloom-tests",
        "local[4]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def reply(name, body, *replies, author="ann", score=0, **more):
    """A comment as a batch file holds it."""
    day = {"created_date": "2021-12-31T23:59:59"}
    own = {"id": name, "author": author, "body": body, "upvotes": score, "is_submitter": False}
    return {**own, **day, "replies": list(replies), **more}


@pytest.fixture
def raw_post():
    """Two threads: one three levels deep through a comment without text, and one with nothing below."""
    deep = reply("k3", "~~Straw~~ wool", author="moss", is_submitter=True)
    first = reply("k1", "1 < 2 &lt; 3", reply("k2", "", deep), reply("k4", "  "), score=-4)
    return {
        "id": "q7",
        "title": "Hives & *frost*",
        "text": "# Box A\n\n\n\n\n- feed......",
        "author": "moss",
        "created_date": "2021-12-01T00:00:00",
        "upvotes": -2,
        "num_comments": 9,
        "comments": [first, reply("k5", "No", author="cy")],
    }
