import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from ledgerline.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ledgerline-tests",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def clean(spark, sf_dir):
    from ledgerline.plans.workload import staged

    return staged(spark, sf_dir, "canonical")


@pytest.fixture(scope="session")
def medium(spark):
    """The clean table at the next scale, for fits that need some rows."""
    from ledgerline.plans.workload import staged

    return staged(spark, "/root/testdata/sf0.01", "canonical")
