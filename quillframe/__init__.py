"""quillframe: getting tables ready for modelling, and comparing models on them, as Spark jobs."""

from quillframe.errors import TableError
from quillframe.operators.cleaning import (
    convert_type, custom_clean, custom_clean_batches, fill_missing, normalize, remove_duplicates, remove_missing,
    remove_outliers, replace_values,
)
from quillframe.operators.joins import join_tables
from quillframe.operators.models import CustomModel
from quillframe.operators.predicates import field, keep_rows
from quillframe.operators.projection import drop_columns, rename_columns, select_columns
from quillframe.operators.sampling import hash_sample, random_split, stratified_split, within_budget
from quillframe.plans.compare import ModelRequest, compare_models
from quillframe.plans.pipeline import clean, run_steps
from quillframe.plans.profile import profile
from quillframe.sources.tables import read_csv, read_parquet, write_csv
from quillframe.sources.workspace import Workspace

__all__ = [
    "CustomModel", "ModelRequest", "TableError", "Workspace", "clean", "compare_models", "convert_type", "custom_clean",
    "custom_clean_batches", "drop_columns", "field", "fill_missing", "hash_sample", "join_tables", "keep_rows", "normalize",
    "profile", "random_split", "read_csv", "read_parquet", "remove_duplicates", "remove_missing", "remove_outliers",
    "rename_columns", "replace_values", "run_steps", "select_columns", "stratified_split", "within_budget", "write_csv",
]
