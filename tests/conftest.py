import contextlib
import io
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from sectorloom.session import builder  # noqa: E402
from sectorloom.sources.schemas import actual, fields  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        builder("local[4]")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SMALL


def padded(df, schema):
    """``df`` with the columns of a declared schema that a test does not care about, as NULL."""
    absent = {n: F.lit(None).cast(kind) for n, kind in fields(schema) if actual(df, n) is None}
    return df.withColumns(absent)


def as_set(df):
    return {tuple(row) for row in df.collect()}


def as_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df, mode="simple"):
    """The physical plan as text; ``formatted`` lists filters and columns in full."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()
