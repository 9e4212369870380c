"""Declared schemas of the tables that operators align to."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

_S, _L, _B = StringType(), LongType(), BooleanType()


def _schema(**kinds) -> StructType:
    return StructType([StructField(k, v) for k, v in kinds.items()])


ACT_CORE = _schema(eli=_S, status=_S, announcementdate=_S, volume=_L, title=_S, type=_S, texthtml=_B, document_year=_L)
ACT_PATHS = _schema(eli=_S, title=_S, s3_pdf_path=_S, missing=_B)
ACT_CHANGES = _schema(eli=_S, eli_annotation=_S, type_annotation=_S, title_annotation=_S, type_of_change=_S, date_of_change_annotation=_S)
