from featurekit.functions import calendar, numeric, text, values  # noqa: F401
