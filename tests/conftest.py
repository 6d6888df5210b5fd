import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from scrutin.session import local_session
    s = local_session("*", shuffle_partitions=8, app_name="scrutin-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_rows():
    """FIXTURES.md section 1 (4 rows)."""
    return [
        (2022, 1, "31", "RN", 1000, 10000, 7500, 2500, 7000),
        (2022, 2, "31", "REN", 1500, 10000, 8500, 1500, 8000),
        (2017, 1, "34", "LFI", 800, 8000, 6000, 2000, 5500),
        (2017, 2, "34", "PS", 1200, 8000, 6500, 1500, 6000),
    ]


SMOKE_SCHEMA = ("annee INT, tour INT, departement STRING, nuance STRING, voix LONG, inscrits LONG, "
                "votants LONG, abstentions LONG, exprimes LONG")
