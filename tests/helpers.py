import datetime
import math


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 8) + 0.0
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, list):
        return tuple(value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def rows_of(df):
    return canonical(df.columns, df.collect())


def values(df):
    return [tuple(r) for r in df.collect()]
