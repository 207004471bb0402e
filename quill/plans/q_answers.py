"""Model-answer queries over answers derived from ``lineitem``: F25-F32, P8,
A8, S14."""

from __future__ import annotations

from pyspark.sql import functions as F

from quill.operators import answers as AN
from quill.plans.registry import register
from quill.sources.tables import table


def model_answers(spark, sf):
    l = table(spark, sf, "lineitem")
    x0 = F.pmod(F.col("l_partkey") * 7, F.lit(500))
    y0 = F.pmod(F.col("l_suppkey") * 13, F.lit(500))
    # every 29th order: a right edge far beyond an int
    x1 = x0 + 100 + F.pmod("l_orderkey", F.lit(400)) + F.when(F.pmod("l_orderkey", F.lit(29)) == 0, F.lit(99999999999)).otherwise(F.lit(0))
    y1 = y0 + 50 + F.pmod(F.col("l_linenumber") * 37, F.lit(450))
    s = lambda c: c.cast("string")
    kind = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(5))
    text = (F.when(kind == 0, F.concat(F.lit('Here is the box: {"xmin": '), s(x0), F.lit(', "ymin": '), s(y0),
                                       F.lit(', "xmax": '), s(x1), F.lit(', "ymax": '), s(y1), F.lit("} done")))
            .when(kind == 1, F.concat(F.lit('Box {"xmin": ['), s(x0), F.lit('], "ymin": [ '), s(y0), F.lit(' ], "xmax": '),
                                      s(x1), F.lit(', "ymax": ['), s(y1), F.lit("]}")))
            .when(kind == 2, F.concat(F.lit('{"xmin": '), s(x0), F.lit(', "ymin": '), s(y0), F.lit(', "xmax": '), s(x1),
                                      F.lit(', "ymax": '), s(y1), F.lit(",}")))
            .when(kind == 3, F.concat(F.lit('{"xmin": '), s(x0), F.lit(', "ymin": '), s(y0), F.lit("}")))
            .otherwise(F.lit("no box found")))
    objects = F.concat(F.lit('[{"xmin": '), s(x0), F.lit(', "ymin": '), s(y0), F.lit(', "xmax": '), s(x1),
                       F.lit(', "ymax": '), s(y1), F.lit(', "label": "Part '), s(F.col("l_partkey")), F.lit('"}, {"xmin": ['),
                       s(y0), F.lit('], "ymin": '), s(x0), F.lit(', "xmax": '), s(y1), F.lit(', "ymax": '), s(x1),
                       F.lit('}, {"xmin": "bad", "ymin": 1, "xmax": 2, "ymax": 3}]'))
    w = (F.lit(200) + F.col("l_quantity").cast("int") * 20)
    h = (F.lit(300) + F.col("l_quantity").cast("int") * 30)
    return l.select("l_orderkey", "l_linenumber", text.alias("answer"), objects.alias("objects"),
                    w.alias("width"), h.alias("height"))


ANSWERS_SQL = r"""
b AS (SELECT l_orderkey, l_linenumber, (l_partkey * 7) % 500 AS x0, (l_suppkey * 13) % 500 AS y0,
             200 + CAST(l_quantity AS INTEGER) * 20 AS width, 300 + CAST(l_quantity AS INTEGER) * 30 AS height,
             (l_orderkey + l_linenumber) % 5 AS kind, l_orderkey % 400 AS dx, (l_linenumber * 37) % 450 AS dy, l_partkey FROM lineitem),
c AS (SELECT *, x0 + 100 + dx + CASE WHEN l_orderkey % 29 = 0 THEN 99999999999 ELSE 0 END AS x1, y0 + 50 + dy AS y1 FROM b),
a AS (SELECT *, CASE kind
   WHEN 0 THEN 'Here is the box: {"xmin": ' || x0 || ', "ymin": ' || y0 || ', "xmax": ' || x1 || ', "ymax": ' || y1 || '} done'
   WHEN 1 THEN 'Box {"xmin": [' || x0 || '], "ymin": [ ' || y0 || ' ], "xmax": ' || x1 || ', "ymax": [' || y1 || ']}'
   WHEN 2 THEN '{"xmin": ' || x0 || ', "ymin": ' || y0 || ', "xmax": ' || x1 || ', "ymax": ' || y1 || ',}'
   WHEN 3 THEN '{"xmin": ' || x0 || ', "ymin": ' || y0 || '}'
   ELSE 'no box found' END AS answer FROM c),
r AS (SELECT *, regexp_replace(CASE WHEN regexp_matches(answer, '(?s)\{.*?\}') THEN regexp_extract(answer, '(?s)\{.*?\}', 0) ELSE answer END,
                               '\[\s*(\d+)\s*\]', '\1', 'g') AS rep FROM a),
m0 AS (SELECT *, NOT json_valid(rep) OR regexp_matches(rep, ',\s*[}\]]') AS malformed FROM r),
m AS (SELECT *, CASE WHEN malformed THEN NULL ELSE rep END AS jr FROM m0),
j AS (SELECT *, NOT malformed AND TRY_CAST(trim(json_extract_string(jr, '$.xmin')) AS DOUBLE) IS NOT NULL
                AND TRY_CAST(trim(json_extract_string(jr, '$.ymin')) AS DOUBLE) IS NOT NULL
                AND TRY_CAST(trim(json_extract_string(jr, '$.xmax')) AS DOUBLE) IS NOT NULL
                AND TRY_CAST(trim(json_extract_string(jr, '$.ymax')) AS DOUBLE) IS NOT NULL AS json_all,
             malformed AND regexp_matches(rep, '"xmin":\s*\[?(\d+)') AND regexp_matches(rep, '"ymin":\s*\[?(\d+)')
                AND regexp_matches(rep, '"xmax":\s*\[?(\d+)') AND regexp_matches(rep, '"ymax":\s*\[?(\d+)') AS rx_all FROM m),
v AS (SELECT *, CASE WHEN json_all THEN 'json' WHEN rx_all THEN 'regex' END AS method,
        CASE WHEN json_all THEN TRY_CAST(trim(json_extract_string(jr, '$.xmin')) AS DOUBLE) WHEN rx_all THEN CAST(regexp_extract(rep, '"xmin":\s*\[?(\d+)', 1) AS DOUBLE) END AS bx0,
        CASE WHEN json_all THEN TRY_CAST(trim(json_extract_string(jr, '$.ymin')) AS DOUBLE) WHEN rx_all THEN CAST(regexp_extract(rep, '"ymin":\s*\[?(\d+)', 1) AS DOUBLE) END AS by0,
        CASE WHEN json_all THEN TRY_CAST(trim(json_extract_string(jr, '$.xmax')) AS DOUBLE) WHEN rx_all THEN CAST(regexp_extract(rep, '"xmax":\s*\[?(\d+)', 1) AS DOUBLE) END AS bx1,
        CASE WHEN json_all THEN TRY_CAST(trim(json_extract_string(jr, '$.ymax')) AS DOUBLE) WHEN rx_all THEN CAST(regexp_extract(rep, '"ymax":\s*\[?(\d+)', 1) AS DOUBLE) END AS by1
      FROM j),
px AS (SELECT *, CAST(trunc(bx0 / 1000 * width) AS BIGINT) AS ax0, CAST(trunc(by0 / 1000 * height) AS BIGINT) AS ay0,
              CAST(trunc(bx1 / 1000 * width) AS BIGINT) AS ax1, CAST(trunc(by1 / 1000 * height) AS BIGINT) AS ay1 FROM v)
"""


@register("f25_f29_box_answers", sql=f"""
WITH {ANSWERS_SQL}
SELECT l_orderkey, l_linenumber, method IS NOT NULL AS ok, method, ax0, ay0, ax1, ay1,
  CAST(greatest(0, ax0 - CAST(trunc(width * 0.05) AS INTEGER)) AS INTEGER) AS crop_x0,
  CAST(greatest(0, ay0 - CAST(trunc((ay1 - ay0) * 0.05) AS INTEGER)) AS INTEGER) AS crop_y0,
  CAST(least(width, ax1 + CAST(trunc(width * 0.05) AS INTEGER)) AS INTEGER) AS crop_x1,
  CAST(least(height, ay0 + CAST(trunc((ay1 - ay0) * 92 / 100.0) AS INTEGER)) AS INTEGER) AS crop_y1,
  CAST(least(height, ay1 + CAST(trunc((ay1 - ay0) * 0.10) AS INTEGER)) AS INTEGER) AS draw_y1
FROM px
""")
def f25_f29_box_answers(spark, sf):
    a = model_answers(spark, sf)
    b = AN.with_box(a, "answer")
    px = AN.to_pixels(F.col("box"), F.col("width"), F.col("height"))
    b = b.withColumn("px", px)
    crop = AN.pad_main(F.col("px"), F.col("width"), F.col("height"), crop=True)
    draw = AN.pad_main(F.col("px"), F.col("width"), F.col("height"), crop=False)
    return b.select("l_orderkey", "l_linenumber", F.col("box").isNotNull().alias("ok"), F.col("box.method").alias("method"),
                    F.col("px.xmin").alias("ax0"), F.col("px.ymin").alias("ay0"), F.col("px.xmax").alias("ax1"),
                    F.col("px.ymax").alias("ay1"), crop["xmin"].alias("crop_x0"), crop["ymin"].alias("crop_y0"),
                    crop["xmax"].alias("crop_x1"), crop["ymax"].alias("crop_y1"), draw["ymax"].alias("draw_y1"))


@register("a8_p8_outcomes", sql=f"""
WITH {ANSWERS_SQL}
SELECT count(*) FILTER (WHERE method IS NOT NULL) AS success, count(*) FILTER (WHERE method IS NULL) AS failure FROM px
""")
def a8_p8_outcomes(spark, sf):
    a = AN.with_box(model_answers(spark, sf), "answer").withColumn("ok", F.col("box").isNotNull())
    return AN.outcome_counts(a)


@register("f27_f30_f32_objects", sql=r"""
WITH b AS (SELECT l_orderkey, l_linenumber, (l_partkey * 7) % 500 AS x0, (l_suppkey * 13) % 500 AS y0,
                  (l_partkey * 7) % 500 + 100 + l_orderkey % 400 + CASE WHEN l_orderkey % 29 = 0 THEN 99999999999 ELSE 0 END AS x1, (l_suppkey * 13) % 500 + 50 + (l_linenumber * 37) % 450 AS y1,
                  200 + CAST(l_quantity AS INTEGER) * 20 AS width, 300 + CAST(l_quantity AS INTEGER) * 30 AS height, l_partkey FROM lineitem),
o AS (SELECT *, '[{"xmin": ' || x0 || ', "ymin": ' || y0 || ', "xmax": ' || x1 || ', "ymax": ' || y1 || ', "label": "Part ' || l_partkey
               || '"}, {"xmin": [' || y0 || '], "ymin": ' || x0 || ', "xmax": ' || y1 || ', "ymax": ' || x1
               || '}, {"xmin": "bad", "ymin": 1, "xmax": 2, "ymax": 3}]' AS objects FROM b),
p AS (SELECT *, from_json(regexp_replace(objects, '\[\s*(\d+)\s*\]', '\1', 'g'),
                 '[{"xmin":"VARCHAR","ymin":"VARCHAR","xmax":"VARCHAR","ymax":"VARCHAR","label":"VARCHAR"}]') AS arr FROM o),
f AS (SELECT l_orderkey, l_linenumber, width, height, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS i, unnest(arr) AS ob FROM p),
u AS (SELECT * FROM f WHERE TRY_CAST(ob.xmin AS DOUBLE) IS NOT NULL AND regexp_matches(ob.xmin, '^-?[0-9.eE+-]+$')
      AND TRY_CAST(ob.ymin AS DOUBLE) IS NOT NULL AND TRY_CAST(ob.xmax AS DOUBLE) IS NOT NULL AND TRY_CAST(ob.ymax AS DOUBLE) IS NOT NULL),
px AS (SELECT *, coalesce(ob.label, 'Object') AS label,
         CAST(trunc(CAST(ob.xmin AS DOUBLE) / 1000 * width) AS BIGINT) AS ax0, CAST(trunc(CAST(ob.ymin AS DOUBLE) / 1000 * height) AS BIGINT) AS ay0,
         CAST(trunc(CAST(ob.xmax AS DOUBLE) / 1000 * width) AS BIGINT) AS ax1, CAST(trunc(CAST(ob.ymax AS DOUBLE) / 1000 * height) AS BIGINT) AS ay1 FROM u)
SELECT l_orderkey, l_linenumber, i, label,
  CAST(greatest(0, ax0 - CAST(trunc(width * 0.03) AS BIGINT)) AS INTEGER) AS x0,
  CAST(greatest(0, ay0 - CAST(trunc((ay1 - ay0) * 0.05) AS BIGINT)) AS INTEGER) AS y0,
  CAST(least(width, ax1 + CAST(trunc(width * 0.03) AS BIGINT)) AS INTEGER) AS x1,
  CAST(least(height, ay1 + CAST(trunc((ay1 - ay0) * 0.05) AS BIGINT)) AS INTEGER) AS y1,
  'shot-' || l_orderkey || '_' || (i + 1) || '_' || replace(lower(coalesce(ob.label, 'Object')), ' ', '_') || '.png' AS file
FROM px
""")
def f27_f30_f32_objects(spark, sf):
    a = model_answers(spark, sf)
    o = a.select("l_orderkey", "l_linenumber", "width", "height",
                 F.posexplode_outer(AN.parse_objects(F.col("objects"))).alias("i", "ob")).filter(F.col("ob").isNotNull())
    px = AN.to_pixels(F.col("ob"), F.col("width"), F.col("height"))
    box = AN.pad_objects(px, F.col("width"), F.col("height"), crop=True)
    name = F.concat(F.lit("shot-"), F.col("l_orderkey").cast("string"), F.lit(".png"))
    return o.select("l_orderkey", "l_linenumber", "i", F.col("ob.label").alias("label"), box["xmin"].alias("x0"),
                    box["ymin"].alias("y0"), box["xmax"].alias("x1"), box["ymax"].alias("y1"),
                    AN.object_name(name, F.col("i"), F.col("ob.label")).alias("file"))


@register("f31_f32_canvas_fit", sql=r"""
WITH b AS (SELECT l_orderkey, l_linenumber, 200 + CAST(l_quantity AS INTEGER) * 20 AS width,
                  300 + ((l_orderkey * 31 + l_linenumber) % 1700) AS height FROM lineitem),
f AS (SELECT *, width / height AS aspect FROM b),
g AS (SELECT *, CASE WHEN aspect > 1080 / 1350 THEN 1080 ELSE CAST(trunc(1350 * aspect) AS INTEGER) END AS nw,
                CASE WHEN aspect > 1080 / 1350 THEN CAST(trunc(1080 / aspect) AS INTEGER) ELSE 1350 END AS nh FROM f)
SELECT l_orderkey, l_linenumber, nw AS new_width, nh AS new_height, CAST(floor((1080 - nw) / 2) AS INTEGER) AS x,
       CAST(floor((1350 - nh) / 2) AS INTEGER) AS y,
       'shot-' || l_orderkey || '-' || l_linenumber || '_cropped_larger.png' AS larger_name,
       'shot-' || l_orderkey || '-' || l_linenumber || '_bbox.png' AS bbox_name
FROM g
""")
def f31_f32_canvas_fit(spark, sf):
    l = table(spark, sf, "lineitem")
    w = F.lit(200) + F.col("l_quantity").cast("int") * 20
    h = F.lit(300) + F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber"), F.lit(1700))
    d = l.select("l_orderkey", "l_linenumber", w.alias("width"), h.cast("int").alias("height"))
    fit = AN.fit_canvas(F.col("width"), F.col("height"))
    name = F.concat(F.lit("shot-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit(".png"))
    return d.select("l_orderkey", "l_linenumber", fit["width"].alias("new_width"), fit["height"].alias("new_height"),
                    fit["x"].alias("x"), fit["y"].alias("y"),
                    AN.larger_name(AN.output_name(name, crop=True)).alias("larger_name"),
                    AN.output_name(name, crop=False).alias("bbox_name"))


@register("s14_image_inventory", sql=r"""
WITH f AS (SELECT doc_id, source || '/' || CASE doc_id % 6 WHEN 0 THEN '.hidden-' || doc_id || '.png' WHEN 1 THEN 'img-' || doc_id || '.JPG'
                  WHEN 2 THEN 'img-' || doc_id || '.webp' WHEN 3 THEN 'notes-' || doc_id || '.txt'
                  WHEN 4 THEN 'img-' || doc_id || '.tar.gz' ELSE 'img-' || doc_id || '.jpeg' END AS path FROM documents),
b AS (SELECT *, string_split(path, '/')[-1] AS base FROM f),
e AS (SELECT *, CASE WHEN regexp_matches(base, '^\.[^.]*$') THEN '' ELSE coalesce(nullif(regexp_extract(base, '(\.[^.]*)$', 1), base), '') END AS ext FROM b)
SELECT doc_id, path FROM e WHERE NOT starts_with(base, '.') AND lower(ext) IN ('.jpg', '.jpeg', '.png', '.gif', '.bmp', '.webp')
""")
def s14_image_inventory(spark, sf):
    d = table(spark, sf, "documents")
    k = F.pmod("doc_id", F.lit(6))
    i = F.col("doc_id").cast("string")
    name = (F.when(k == 0, F.concat(F.lit(".hidden-"), i, F.lit(".png"))).when(k == 1, F.concat(F.lit("img-"), i, F.lit(".JPG")))
            .when(k == 2, F.concat(F.lit("img-"), i, F.lit(".webp"))).when(k == 3, F.concat(F.lit("notes-"), i, F.lit(".txt")))
            .when(k == 4, F.concat(F.lit("img-"), i, F.lit(".tar.gz"))).otherwise(F.concat(F.lit("img-"), i, F.lit(".jpeg"))))
    f = d.select("doc_id", F.concat(F.col("source"), F.lit("/"), name).alias("path"))
    return f.filter(AN.is_image(F.col("path")))
