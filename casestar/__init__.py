"""casestar: incident records to a star-schema warehouse to answers, on Spark DataFrames."""

from casestar.config import CleanRules, QuestionRules, RawColumns
from casestar.plans.etl import build_warehouse, clean_records
from casestar.session import get_session
from casestar.sources.warehouse import Warehouse, open_warehouse

__all__ = [
    "CleanRules",
    "QuestionRules",
    "RawColumns",
    "Warehouse",
    "build_warehouse",
    "clean_records",
    "get_session",
    "open_warehouse",
]
