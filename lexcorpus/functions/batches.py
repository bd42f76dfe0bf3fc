"""Arrow batch steps: each maps a batch of payloads with a small per-row reader.

The readers travel with the job, so executors need not have this package installed.
"""

from __future__ import annotations

import html
import sys

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

from lexcorpus.functions import markup
from lexcorpus.functions.markup import read_page


TEXT = pa.string()
#: Parts of a read page as Arrow types.
PAGE_TYPES = {
    "text_lines": TEXT,
    "text_visible": TEXT,
    "text_plain": TEXT,
    "places": pa.list_(pa.struct({"tag": TEXT, "classes": pa.list_(TEXT), "ident": TEXT, "text": TEXT}.items())),
    "links": pa.list_(pa.struct({"pos": pa.int32(), "href": TEXT, "url": TEXT, "label": TEXT}.items())),
    "metas": pa.list_(pa.struct({"name": TEXT, "property": TEXT, "content": TEXT}.items())),
}


def page_batch(parts: tuple[str, ...]):
    """A reader of the named parts of pages."""
    kind = pa.struct([(name, PAGE_TYPES[name]) for name in parts])

    def read(bodies: pa.Array, bases: pa.Array) -> pa.Array:
        rows = [read_page(b, u, parts) for b, u in zip(bodies.to_pylist(), bases.to_pylist())]
        return pa.array(rows, type=kind)

    return read


def unescape_batch(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(markup)
