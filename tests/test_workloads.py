"""The classic programs over small files in their formats."""

import random

import pytest

from loamwork.learning import recommend, tune
from loamwork.operators.splits import contiguous_folds, leave_range_out, random_split
from loamwork.sources.models import save_model
from loamwork.workloads import cover, movies, pages, people, rentals, supervised, words
from loamwork.workspace import fresh_path


def put(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_words(spark, tmp_path):
    source = put(tmp_path / "text", ["Apple Apple Orange", "Banana Grape Grape"])
    counts = words.count_words(spark, source)
    assert {r.word: r.n for r in counts.collect()} == {"Apple": 2, "Orange": 1, "Banana": 1, "Grape": 2}
    target = fresh_path(spark, "test")
    assert words.save_counts(counts, target) and not words.save_counts(counts, target)


@pytest.fixture(scope="module")
def users(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("people")
    file = put(folder / "users", [
        "1|27|M|baker|20001", "2|61|F|glazier|20002", "3|26|M|painter|20003",
        "4|27|M|baker|T9Z9Z", "5|44|F|glazier|02099", "6|52|M|tailor|99999",
    ])
    return people.read_users(spark, file)


@pytest.fixture(scope="module")
def zipcodes(spark, tmp_path_factory):
    file = put(tmp_path_factory.mktemp("zips") / "zips", [
        '"Zipcode","ZipCodeType","City","State","LocationType","Lat"',
        '"20001","STANDARD","SANDFORD","AZ","PRIMARY",31.5', '"20002","STANDARD","HIGH MEADOW","CA","PRIMARY",36.5',
        '"20003","PO BOX","LOW MARSH","FL","PRIMARY",29.5', '"02099","STANDARD","MILLTON, N","MA","PRIMARY",41.5',
    ])
    return people.read_zipcodes(spark, file)


def test_zipcodes_keep_four_columns(zipcodes):
    assert sorted(tuple(r) for r in zipcodes.collect()) == [
        (2099, "STANDARD", "MILLTON, N", "MA"), (20001, "STANDARD", "SANDFORD", "AZ"),
        (20002, "STANDARD", "HIGH MEADOW", "CA"), (20003, "PO BOX", "LOW MARSH", "FL"),
    ]


def test_people(users, zipcodes):
    assert {r.userid for r in people.matching(users, "baker", "M", 27).collect()} == {1, 4}
    assert [r.userid for r in people.by_age_and_gender(users).collect()] == [2, 6, 5, 1, 4, 3]
    assert people.with_birth_year(users).filter("userid = 1").first().birthyear == 1989
    assert {r.state: r.n for r in people.by_state(users, zipcodes).collect()} == {"AZ": 1, "CA": 1, "FL": 1, "MA": 1, None: 2}
    assert [r.userid for r in people.in_state(users, zipcodes, "CA").collect()] == [2]
    assert people.with_places(users, zipcodes).count() == 6
    table = {r.occupation_gender: (r.F, r.M) for r in people.occupations_by_gender(users).collect()}
    assert table == {"baker": (0, 2), "glazier": (2, 0), "painter": (0, 1), "tailor": (0, 1)}
    assert [tuple(r) for r in people.by_gender_and_occupation(users).collect()] == [
        ("F", "glazier", 2), ("M", "baker", 2), ("M", "painter", 1), ("M", "tailor", 1),
    ]
    assert {r.occupation: r.percent for r in people.occupation_shares(users).collect()}["glazier"] == 33.3


@pytest.fixture(scope="module")
def page_rows(spark, tmp_path_factory):
    rng, folder = random.Random(5), tmp_path_factory.mktemp("pages")
    names = ["url", "urlid", "boilerplate", "alchemy_category", "alchemy_category_score", "avglinksize", "is_news", "label"]
    lines = ["\t".join(f'"{n}"' for n in names)]
    for i in range(240):
        score, size = rng.random(), rng.gauss(0, 1)
        fields = [f"http://p/{i}", i, '{""title"":""a, b""}', rng.choice(["arts", "sports", "?"]),
                  "?" if i % 9 == 0 else round(score, 3), round(size, 3), "?" if i % 2 else 1, int(size > 0)]
        lines.append("\t".join(f'"{f}"' for f in fields))
    labelled = put(folder / "train", lines)
    unlabelled = put(folder / "test", [line.rsplit("\t", 1)[0] for line in lines])
    return pages.read_pages(spark, labelled), pages.read_pages(spark, unlabelled)


def test_page_files(page_rows):
    labelled, unlabelled = page_rows
    assert labelled.columns == ["url", "alchemy_category", "alchemy_category_score", "avglinksize", "is_news", "label"]
    assert unlabelled.columns == labelled.columns[:-1]
    assert labelled.count() == 240 and labelled.filter("alchemy_category_score is null or is_news is null").count() == 0


@pytest.mark.parametrize("family, settings", [
    ("tree", {"impurity": "entropy", "depth": 10, "bins": 200}), ("forest", {"trees": 5}),
    ("logistic", {"iterations": 30}), ("svm", {"iterations": 30, "regularisation": 0.01}),
    ("logistic_sgd", {"iterations": 15, "step": 10.0, "batch_fraction": 1.0}),
    ("svm_sgd", {"iterations": 10, "step": 10.0, "regularisation": 0.01}), ("bayes", {"smoothing": 1.0}),
])
def test_page_models(page_rows, family, settings):
    labelled, unlabelled = page_rows
    train, _, test = random_split(labelled, [8, 1, 1], seed=1)
    fitted = supervised.fit(pages.page_task(labelled), family, train, **settings)
    assert fitted.evaluate(test) > (0.5 if family == "bayes" else 0.75)
    predicted = pages.predict_pages(fitted, unlabelled)
    assert predicted.columns == ["url", "prediction", "description"]
    assert predicted.count() == 240 and predicted.filter("description is null").count() == 0


@pytest.mark.parametrize("family, grid", [
    ("tree", tune.settings_grid(depth=[1, 4], bins=[8, 32])),
    ("svm_sgd", tune.one_axis("regularisation", [0.01, 1.0], iterations=5, step=10.0)),
])
def test_page_tuning(spark, page_rows, family, grid):
    train, validation = random_split(page_rows[0], [7, 3], seed=2)
    done, best = supervised.tune(pages.page_task(page_rows[0]), family, train, validation, grid)
    assert len(done.trials) == len(grid)
    assert best.evaluate(validation) == pytest.approx(max(t.metric for t in done.trials))
    assert done.table(spark, "auc").filter("is_best").count() == 1


def test_cover(spark, tmp_path):
    rng, lines = random.Random(7), []
    for _ in range(300):
        kind = rng.randint(1, 7)
        lines.append(",".join(str(v) for v in [2000 + 100 * kind, *[rng.randint(0, 9) for _ in range(53)], kind]))
    rows = cover.read_cover(spark, put(tmp_path / "cover", lines))
    assert rows.columns == [*[f"f{i}" for i in range(54)], "label"]
    assert {r.label for r in rows.select("label").distinct().collect()} == set(map(float, range(7)))
    train, test = random_split(rows, [7, 3], seed=3)
    fitted = supervised.fit(cover.COVER, "tree", train, impurity="entropy", depth=5, bins=50)
    assert fitted.evaluate(test) > 0.9
    predicted = cover.predict_cover(fitted, rows)
    assert predicted.columns == ["海拔", "方位", "斜率", "垂直距离", "水平距离", "阴影", "label", "prediction", "correct"]
    assert predicted.count() == 300


def test_rentals(spark, tmp_path):
    rng = random.Random(9)
    lines = ["instant,dteday,season,yr,mnth,hr,holiday,weekday,workingday,weathersit,temp,atemp,hum,windspeed,casual,registered,cnt"]
    for i in range(400):
        hour = i % 24
        count = 10 + 5 * hour + rng.randint(0, 3)
        lines.append(f"{i},2011-01-01,{i % 4 + 1},0,{i % 12 + 1},{hour},0,{i % 7},1,{i % 4 + 1},0.24,0.28,0.81,0.1,1,{count - 1},{count}")
    rows = rentals.read_hours(spark, put(tmp_path / "hours", lines))
    assert len(rows.columns) == 12 and rows.columns[-1] == "cnt"
    train, test = random_split(rows, [7, 3], seed=4)
    for task, family, settings in (
        (rentals.RENTALS, "tree_regressor", {"depth": 10, "bins": 100}),
        (rentals.RENTALS_INDEXED, "forest_regressor", {"trees": 5, "maxBins": 32}),
        (rentals.RENTALS_INDEXED, "boosted_regressor", {"maxIter": 3}),
    ):
        fitted = supervised.fit(task, family, train, **settings)
        assert fitted.evaluate(test) < 25
    report = rentals.predict_hours(fitted, rows)
    assert report.count() == 400
    first = report.first()
    assert first.season in "春夏秋冬" and first.abs_error == abs(first.actual - first.predicted)


@pytest.fixture(scope="module")
def ratings(spark, tmp_path_factory):
    rng, lines = random.Random(11), []
    for user in range(1, 41):
        for item in rng.sample(range(1, 31), 15):
            lines.append(f"{user}\t{item}\t{1 + (user + item) % 5}\t88125{len(lines)}")
    return movies.read_ratings(spark, put(tmp_path_factory.mktemp("movies") / "ratings", lines))


def test_movies(spark, ratings, tmp_path):
    titles = movies.read_titles(spark, put(tmp_path / "items", [
        f"{i}|Film {i} (1995)|01-Jan-1995||http://x" + "|0" * 19 for i in range(1, 31)
    ]))
    assert tuple(recommend.profile(ratings).first()) == (600, 40, 30)
    parts = movies.split_ratings(ratings)
    assert sum(p.count() for p in parts.values()) == 600
    done = movies.tune_ratings(parts["train"], parts["validation"], tune.settings_grid(rank=[2, 8], maxIter=[5], regParam=[0.01]))
    assert done.best.metric == min(t.metric for t in done.trials)
    assert movies.rating_error(done.best.model, parts["validation"]) == pytest.approx(done.best.metric)
    assert movies.rating_error(done.best.model, parts["test"]) > 0
    path = fresh_path(spark, "test")
    assert save_model(done.best.model, path)
    listed = recommend.serve(spark, path, "U", 5, 10, titles).collect()
    assert len(listed) == 10 and all(r.title == f"Film {r.item_id} (1995)" for r in listed)


def test_rating_folds_and_leave_ten_out(ratings):
    folds = contiguous_folds(ratings, ["user_id", "item_id"], 5)
    assert {r.fold: r["count"] for r in folds.groupBy("fold").count().collect()} == {i: 120 for i in range(5)}
    split = leave_range_out(ratings, "user_id", ["item_id"], 1, 10)
    tests = split.filter("split = 'test'").groupBy("user_id").count().collect()
    assert len(tests) == 40 and {r["count"] for r in tests} == {10}
