import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegrid.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def compile_large_plans_only(request, spark):
    """Tiny cases spend most of their time compiling generated code: interpret them.

    The queries on the shared tables run with the default settings.
    """
    tiny = request.node.path.name != "test_queries.py"
    spark.conf.set("spark.sql.codegen.wholeStage", "false" if tiny else "true")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
