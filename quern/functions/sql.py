"""The functions that need Python, under names that SQL text can use."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from quern.functions import markup, text


@udtf(returnType="pos int, type string, node string")
class JsonLd:
    """Rows of a page's linked-data objects, in order: lists and graphs opened up, broken scripts passed over."""

    def eval(self, html: str) -> Iterator[tuple[int, str | None, str]]:
        for pos, node in enumerate(markup.linked_nodes(html or "")):
            kind = json.loads(node).get("@type")
            yield pos, kind if isinstance(kind, str) else None, node


SCALARS = {"html_text": markup.html_text, "data_page": markup.data_page, "joined_url": markup.joined_url, "unescaped": markup.unescaped, "name_similarity": text.similarity, "folded": text.folded}


def register(spark: SparkSession) -> None:
    """Puts all of them under their names in this session: scalars, and ``extract_json_ld`` for LATERAL joins."""
    for name, function in SCALARS.items():
        spark.udf.register(name, function)
    spark.udtf.register("extract_json_ld", JsonLd)
