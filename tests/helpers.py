import math


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 6)
        return repr(r + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return sorted(cols), rows_of(cols, res.fetchall())
