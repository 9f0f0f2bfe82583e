"""Test inputs: the literal rows of the original programs, and synthetic cases.

Fixed values: the literal inputs below are the original programs' own
example data (and its one order data file), copied as data so that the
"""

# Users and cities of the join programs.
USERS = [(1, "zs"), (2, "ls"), (3, "ww")]
CITIES = [(1, "beijing"), (2, "shanghai"), (4, "guangzhou")]

# The broadcast map (name -> age) and the names looked up.
AGES = [("zs", 18), ("ls", 20), ("ww", 17)]
NAMES = ["zs", "ls", "ww", "zl"]

# The first-n input, (k, name) in arrival order.
FIRSTN = [(2, "zs"), (4, "ls"), (3, "ww"), (2, "zl"), (9, "sq"), (9, "wb"), (7, "ly"), (8, "ce")]

# The counter program's rows.
LETTERS = ["a", "b", "c", "d", "e", "f", "g", "h"]

# The keyed values of the state programs, (k, v) in arrival order.
KEYED_VALUES = [(1, 3), (1, 5), (2, 5), (2, 5), (1, 5), (1, 6), (2, 4)]

# The tab-separated order data file, 12 lines.
ORDER_LINES = [
    "6623957652\t248800\t18\t3887511420\tCFT\tnull\t2020-09-18 00:00:02\t2020-09-18 00:30:02",
    "6623965357\t68900\t18\t8250665267\tCFT\tnull\t2020-09-18 00:00:03\t2020-09-19 00:00:03",
    "6623970561\t150\t6\t69054478\tOTHERS\t6239707419\t2020-09-18 00:00:05\t2020-09-18 01:05:15",
    "6623980623\t178900\t19\t8770558208\tCFT\tnull\t2020-09-18 00:00:07\t2020-09-18 00:04:17",
    "6624001594\t90000\t18\t9920862105\tCFT\tnull\t2020-09-18 00:00:12\t2020-09-18 02:00:12",
    "6624022335\t450\t6\t3030020066\tOTHERS\t6240225284\t2020-09-18 00:00:17\t2020-09-18 01:05:28",
    "6624052441\t4300\t3\t6141687819\tOTHERS\t6240524417\t2020-09-18 00:00:24\t2020-09-18 00:00:36",
    "6624069063\t12000\t4\t3419251087\tOTHERS\t6240690638\t2020-09-18 00:00:28\t2020-09-18 00:05:25",
    "6624070378\t267000\t19\t45869074\tCFT\tnull\t2020-09-18 00:00:30\t2020-09-18 01:52:37",
    "6624079083\t170\t6\t9448759001\t\t6240792935\t2020-09-18 00:00:40\t2020-09-18 01:05:49",
    "6624079085\t170\t6\t9448759001\t\t6240792936\t2020-09-19 00:00:40\t2020-09-18 01:05:49",
    "6624079087\t170\t6\t9448759001\t\t6240792937\t2020-09-19 00:00:40\t2020-09-18 01:05:49",
]
