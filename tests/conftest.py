import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.schemas import ELEMENTS  # noqa: E402
from quarry.session import local_session  # noqa: E402

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def metadata(**known):
    fields = ("page_number", "text_as_html", "image_base64", "filetype", "image_description", "has_image")
    return tuple(known.get(f) for f in fields)


TABLE_2X2 = "<table><tr><th>Stone</th><th>Weight</th></tr><tr><td>slate</td><td>heavy</td></tr></table>"
SAMPLE = [
    ("Title", "Overview", metadata(page_number=1)),
    (
        "NarrativeText",
        "The north pit was opened in early spring. It yields pale sandstone.",
        metadata(page_number=1),
    ),
    ("NarrativeText", "A narrow track now leads from the pit to the harbour.", metadata(page_number=1)),
    ("Table", "Stone | Weight\nslate | heavy", metadata(page_number=2, text_as_html=TABLE_2X2)),
    ("Image", "", metadata(page_number=3, image_base64="iVBORw0KGgo=", filetype="png")),
]


@pytest.fixture
def make_elements(spark):
    def make(rows, document="doc"):
        return spark.createDataFrame([(document, i, *row) for i, row in enumerate(rows)], ELEMENTS)

    return make


@pytest.fixture
def sample(make_elements):
    return make_elements(SAMPLE)
