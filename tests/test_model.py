"""The trainable baseline: held-out accuracy and the inference plan."""

from pyspark.sql import functions as F

from lexframe.operators import model as M


def test_baseline_learns_and_infers(spark, tmp_path):
    entity = "array<struct<start_char:int,end_char:int,text:string,label:string>>"
    rows = []
    for i in range(60):
        number, office = f"{i}/20{i % 10}0/QĐ-A{'BCD'[i % 3]}", ["Bộ Muối", "Sở Đo", "Cục Đê"][i % 3]
        text = f"{office} ban hành\nSố {number} về việc {'kiểm tra ' * (i % 4)}kho"
        at = text.index(number)
        rows.append((i, text, [(0, len(office), office, "CO_QUAN"), (at, at + len(number), number, "SO_HIEU")], "train" if i < 36 else "validation" if i < 48 else "test"))
    rows.append((99, None, None, "train"))
    df = spark.createDataFrame(rows, f"row_id int, text string, entities {entity}, split string")
    best, history, metrics = M.train_and_evaluate(df, weights=(2.0,))
    assert history[2.0] > 0.95 and min(r.f1 for r in metrics.collect()) > 0.95
    best.save(str(tmp_path / "m"))
    again = M.BaselineClassifier.load(str(tmp_path / "m"))
    texts = df.where("split = 'test'").select("row_id", "text")
    rules = texts.select("row_id", F.lit("LOAI").alias("label"), F.lit(8).alias("start_char"), F.lit(11).alias("end_char")).limit(1)
    found = M.infer_entities(texts, "text", ["row_id"], again, rules=rules).collect()
    assert {r.label for r in found} >= {"CO_QUAN", "SO_HIEU"} and all(r.entity_no >= 0 and r.text for r in found)
    assert {r.block_no for r in found if r.label == "SO_HIEU"} == {1}
