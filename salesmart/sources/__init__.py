from . import feeds, schemas, writers  # noqa: F401
from .tables import Tables  # noqa: F401
