"""Golden events, and rows as tuples, for the tests."""

from __future__ import annotations

GOLDEN = """\
event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session
2020-04-01 00:05:00 UTC,view,1,10,electronics.smartphone,samsung,100.00,1,s1
2020-04-01 00:10:00 UTC,cart,1,10,electronics.smartphone,samsung,100.00,1,s1
2020-04-01 00:15:00 UTC,purchase,1,10,electronics.smartphone,samsung,100.00,1,s1
2020-04-01 01:00:00 UTC,view,2,10,electronics.audio.headphone,apple,50.00,1,s2
2020-04-01 01:30:00 UTC,cart,2,10,electronics.audio.headphone,apple,50.00,1,s2
2020-04-02 00:20:00 UTC,view,3,11,appliances.kitchen,,20.00,2,s3
2020-04-02 00:25:00 UTC,cart,3,11,appliances.kitchen,,20.00,2,s3
2020-04-02 00:30:00 UTC,purchase,3,11,appliances.kitchen,,20.00,2,s3
2020-04-02 02:00:00 UTC,purchase,4,12,,  Apple ,30.00,3,s4
2020-04-02 02:05:00 UTC,purchase,,12,  ,  ,40.00,3,s4
not-a-time,purchase,5,13,electronics.smartphone,samsung,60.00,4,s5
2020-04-02 03:00:00 UTC,remove_from_cart,1,10,electronics.smartphone,samsung,100.00,1,s1
2020-04-03 00:00:00 UTC,cart,1,10,Electronics.tablet,samsung,10.00,,s6
2020-04-03 00:01:00 UTC,purchase,1,10,Electronics.tablet,samsung,10.00,,s6
2020-04-03 05:00:00 UTC,view,1,10,electronics.smartphone,samsung,100.00,2,
"""


def rows(frame, *columns):
    """Rows as tuples, in the order of the frame."""
    return [tuple(row) for row in (frame.select(*columns) if columns else frame).collect()]
