from . import constants, keyed, scalars  # noqa: F401
