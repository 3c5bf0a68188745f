import numpy as np
import pytest

from quireline.raster import kernels as K
from quireline.raster import pages, synthetic, udfs
from quireline.sources import files, pdf, sinks

DRAWN = synthetic.drawn()


def test_kernels_on_small_arrays():
    a = np.zeros((5, 5), np.uint8)
    a[2, 2] = 4
    assert K.laplacian_variance(a) == pytest.approx(np.var([4, 4, 4, 4, -16] + [0] * 20))
    m = a > 0
    assert K.dilate(m, 3, 3).sum() == 9 and K.erode(K.dilate(m, 3, 3), 3, 3).sum() == 1
    assert K.box_mean(a, 5)[2, 2] == pytest.approx(4 / 25)
    assert K.median(np.arange(25, dtype=np.uint8).reshape(5, 5), 3)[2, 2] == 12
    big = np.random.default_rng(1).integers(0, 255, (30, 30)).astype(np.uint8)
    want = np.median(np.lib.stride_tricks.sliding_window_view(np.pad(big, 4, mode="edge"), (9, 9)), axis=(2, 3))
    assert (K.median(big, 9) == want).all()


def test_components_join_diagonals_and_arms():
    m = np.array([[1, 0, 1, 0], [1, 0, 1, 0], [1, 1, 1, 0], [0, 0, 0, 1], [0, 0, 0, 0], [1, 0, 0, 0]], bool)
    assert K.components(m)[1] == 2 and sorted(K.boxes(m)) == [(0, 0, 4, 4), (0, 5, 1, 1)]


def test_otsu_parts_two_levels():
    a = np.array([[10] * 8 + [200] * 8], np.uint8)
    assert K.otsu(a).sum() == 8 and K.otsu(a, inverse=True)[0, 0]


def test_resizing_and_turning_keep_flat_images():
    flat = np.full((20, 30), 77, np.uint8)
    assert (K.resized(flat, 37, 51) == 77).all() and (K.long_side(flat, 10) is flat)
    assert (pages.right_angle(DRAWN["text_lines"], 360) == DRAWN["text_lines"]).all()
    assert pages.right_angle(np.array([[1, 2]], np.uint8), 90).tolist() == [[1], [2]]


def test_page_metrics():
    got = {name: pages.metrics(a) for name, a in DRAWN.items()}
    assert got["blank_white"]["text_density"] == 0 and got["blank_white"]["blur"] == 0
    assert got["table_grid"]["is_table"] and not got["text_lines"]["skew_deg"] > 1
    assert got["small_roi"]["roi_frac"] == pytest.approx(0.3, abs=0.03)
    assert got["text_lines"]["blur"] > 100


@pytest.mark.parametrize("angle", [-7, -2, 3, 10])
def test_deskew_finds_the_angle(angle):
    assert pages.skew_angle(DRAWN[f"skewed_{angle}"]) == pytest.approx(-angle, abs=0.35)


def test_lines():
    assert not pages.detect_lines(DRAWN["text_lines"])["has_line"]
    assert pages.detect_lines(DRAWN["scan_line"])["orientation"] == "h"
    assert pages.detect_lines(DRAWN["border_band"])["orientation"] == "v"
    assert not pages.detect_lines(pages.remove_lines(DRAWN["scan_line"]))["has_line"]
    assert (pages.remove_lines(DRAWN["text_lines"], ratio=0.95) == DRAWN["text_lines"]).all()


def test_lightening_brightens_dark_pages():
    from quireline.config import LightenParams

    a = DRAWN["dark_page"][:80, :80]
    assert pages.passes(a, 2, LightenParams(long_side=80)).mean() > a.mean() + 60


def test_weighted_median():
    assert pages.weighted_median(np.array([3.0, 1.0, 2.0]), np.array([1.0, 1.0, 5.0])) == 2.0


def test_errors_stay_with_their_page(spark):
    df = synthetic.frame(spark).where("path in ('text_lines', 'blank_white')").withColumnRenamed("path", "p")
    from pyspark.sql import functions as F

    bad = df.withColumn("image", F.when(F.col("p") == "blank_white", F.col("image").withField("height", F.lit(7))).otherwise(F.col("image")))
    got = {r.p: (r.blur, r.error) for r in udfs.page_metrics(bad).collect()}
    assert got["text_lines"][1] is None and got["blank_white"][0] is None and got["blank_white"][1].startswith("ValueError")


def test_pdf_round_trip(spark, tmp_path):
    a = DRAWN["text_lines"]
    content = pdf.written([(a.shape[1], a.shape[0], 1, a.tobytes())] * 2)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.PDF").write_bytes(content)
    (tmp_path / "in" / "b.pdf").write_bytes(b"%PD")
    (tmp_path / "in" / "c.txt").write_bytes(b"a\xffb")
    got = pdf.split(files.pdfs(spark, str(tmp_path / "in"))).orderBy("path", "page_no").collect()
    assert [(r.path[-5:], r.page_no, r.error is None) for r in got] == [("a.PDF", 1, True), ("a.PDF", 2, True), ("b.pdf", None, False)]
    assert bytes(got[0].data) == a.tobytes()
    assert [tuple(r) for r in files.texts(spark, str(tmp_path / "in")).collect()] == [("c.txt", "ab")]
    assert sinks.quarantined(pdf.split(files.pdfs(spark, str(tmp_path / "in"))), str(tmp_path / "sorted")) == {"good": 2, "bad": 1}
    assert sinks.target(spark, str(tmp_path / "sorted"), "good").count() == 2 and sinks.target(spark, str(tmp_path / "sorted"), "bad").count() == 1


def test_a_folder_that_fills(spark, tmp_path):
    from quireline.streaming import watch

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(pdf.written([(4, 3, 1, bytes(12))]))
    for _ in range(2):
        watch.through(watch.files(spark, str(tmp_path / "in")), pdf.split, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_later_passes_start_from_the_evened_page(monkeypatch):
    page = np.tile(np.linspace(90, 200, 160).astype(np.uint8)[None, :, None], (160, 1, 3))
    page[40:120:8, 20:140] = 30
    seen = []
    edges = pages.K.edges
    monkeypatch.setattr(pages.K, "edges", lambda light, *a: seen.append(light) or edges(light, *a))
    out = pages.lightened_again(page)
    assert (seen[0] == pages._lightness(page)).all()  # edges are those of the page itself
    row = pages._lightness(out)[10]
    assert int(row.max()) - int(row.min()) < 60  # bright pixels are evened out as well, from 110 levels


def test_straight_lines_search_every_angle(monkeypatch):
    tried = []
    monkeypatch.setattr(pages, "weighted_median", lambda values, weights: 0.0)
    monkeypatch.setattr(pages, "projection_score", lambda mask: float(len(tried) == 1))  # the first angle is best, and stays so
    monkeypatch.setattr(pages.K, "rotated_mask", lambda mask, a: tried.append(round(float(a), 2)) or mask)
    page = np.full((200, 300, 3), 255, np.uint8)
    page[50:54, 20:280] = page[100:104, 20:280] = 0
    assert pages.skew_angle(page) == -35.0 and min(tried[:71]) == -35 and max(tried) == 35


def plain_means(a, h, patch, window):
    """Pixel by pixel, over the mirrored page."""
    r, p = window // 2, patch // 2
    b = np.pad(a.astype(float), r + p, mode="reflect")
    out = np.empty(a.shape)
    for i in range(a.shape[0]):
        for j in range(a.shape[1]):
            y, x = i + r + p, j + r + p
            own, total, weight = b[y - p : y + p + 1, x - p : x + p + 1], 0.0, 0.0
            for dy in range(-r, r + 1):
                for dx in range(-r, r + 1):
                    k = np.exp(-((own - b[y + dy - p : y + dy + p + 1, x + dx - p : x + dx + p + 1]) ** 2).mean() / h**2)
                    total, weight = total + k * b[y + dy, x + dx], weight + k
            out[i, j] = total / weight
    return out


@pytest.mark.parametrize("strip", [1, 1 << 17])
@pytest.mark.parametrize(("patch", "window"), [(3, 5), (7, 9), (1, 3)])
def test_means_of_alike_pixels(monkeypatch, strip, patch, window):
    monkeypatch.setattr(K, "STRIP", strip)  # 16 rows at least
    a = np.random.default_rng(patch).integers(0, 256, (37, 23)).astype(np.uint8)
    a[:, 10:] //= 8
    assert np.abs(K.denoised(a, 20.0, patch, window) - plain_means(a, 20.0, patch, window)).max() <= 0.51


@pytest.mark.parametrize("size", [9, 15, 31, 301])
def test_median_of_large_windows(size):
    a = np.random.default_rng(size).choice([0, 3, 7, 90, 91, 200, 255], (41, 33)).astype(np.uint8)
    b = np.pad(a, size // 2, mode="edge")
    want = np.array([[np.median(b[i : i + size, j : j + size]) for j in range(33)] for i in range(41)])
    assert (K.median(a, size) == want).all()
