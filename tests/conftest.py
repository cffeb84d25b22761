import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cloudtally.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, "4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def warehouse(spark, sample_dir):
    from cloudtally.plans.warehouse import Warehouse
    from cloudtally.sources.sample_inputs import SampleInputs

    return Warehouse(spark, SampleInputs(spark, sample_dir))


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or all of them."""
    columns = df.columns
    found = [tuple(r) for r in df.collect()]
    keys = [columns.index(c) for c in (order or columns)]
    return sorted(found, key=lambda r: tuple((r[k] is None, r[k] if r[k] is not None else 0) for k in keys))


def plan(df):
    """The physical plan as text."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()
