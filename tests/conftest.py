import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from idwarden import schemas  # noqa: E402
from idwarden.plans.session import local_session  # noqa: E402
from idwarden.sources import Sources  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Build sources from dicts; fields not given are NULL."""

    def build(**rows_by_source) -> Sources:
        frames = {}
        for source, rows in rows_by_source.items():
            layout = schemas.BY_SOURCE[source]
            values = [tuple(row.get(f.name) for f in layout.fields) for row in rows]
            frames[source] = spark.createDataFrame(values, layout)
        return Sources.of(spark, frames)

    return build
