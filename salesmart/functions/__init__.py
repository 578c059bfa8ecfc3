from . import arrays, calendar, masks, money, text  # noqa: F401
