from .domain import DOMAIN_TABLES, Domain  # noqa: F401
from .tables import DRIVER_TABLES, load, scan_table  # noqa: F401
