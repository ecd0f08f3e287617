from starloom.sources.readers import read_csv, load_sources, category_translation
from starloom.sources.profile import profile_sources
from starloom.sources.schemas import SCHEMAS, FILE_NAMES
from starloom.sources.testdata import testdata_sources, read_table

__all__ = ["read_csv", "load_sources", "category_translation", "profile_sources", "SCHEMAS",
           "FILE_NAMES", "testdata_sources", "read_table"]
