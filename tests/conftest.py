import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabwright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("4", "tabwright-tests", str(tmp_path_factory.mktemp("warehouse")))


@pytest.fixture
def lines_of(spark):
    """Line table out of {file: [lines]}, files in the order given."""
    def build(files):
        rows = []
        for file_ord, (file, lines) in enumerate(files.items()):
            for place, line in enumerate(lines, start=1):
                rows.append((file, file_ord, place, (file_ord << 40) + place, line))
        return spark.createDataFrame(rows, "file string, file_ord bigint, line_no bigint, ord bigint, line string")

    return build


@pytest.fixture
def records_of(spark):
    """Record table with ``_row_no`` out of tuples."""
    def build(names, rows):
        schema = ", ".join(f"`{name}` string" for name in names) + ", _row_no bigint"
        return spark.createDataFrame([(*row, place) for place, row in enumerate(rows, start=1)], schema)

    return build


def tuples(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]
