import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from docrel.session import get_session
    # catalog tables (bucketing test) go to a private folder, not the working directory
    s = get_session("local[8]", 8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="docrel-wh-")})
    yield s
    s.stop()
