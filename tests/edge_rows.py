"""Eleven lines that touch every edge rule."""

LINES = """event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session
2019-11-01 00:00:00 UTC,purchase,1,2,a.b,apple,10.005,5,s1
2019-11-01 00:00:01 UTC,purchase,1,2,,,20.00,5,s1
2019-11-01 00:00:02 UTC,purchase,1,2,,"",20.00,5,s1
2019-11-01 00:00:03 UTC,purchase,1,2,,   ,20.00,5,s1
2019-11-02 00:00:03 UTC,purchase,x,2,,lg,0,5,s1
2019-11-02 00:00:03 UTC,purchase,1,2,,lg,-3,5,s1
2019-11-02 00:00:03 UTC,purchase,1,2,,lg,NaN,5,s1
2019-11-02 00:00:03 UTC,purchase,1,2,,lg,abc,5,s1
2019-11-31 00:00:03 UTC,purchase,1,2,,sony,,5,s1
garbage,,1,2,,sony,1,5,s1
2019-11-03 00:00:03 UTC,Purchase,1,2,,sony,1,5,s1
"""


def write_edge_file(folder, name="edge.csv", text=LINES) -> str:
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)
