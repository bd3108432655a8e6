import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from labelkit.session import local_session

    s = local_session(8, "labelkit-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def nb_setup(spark):
    """Prepared quality fixture at sf0.01 and a Naive Bayes model on its train side."""
    from labelkit.plans import catalog

    prep, model = catalog.fitted(spark, SF01, "naive_bayes")
    return prep, model


@pytest.fixture(scope="session")
def lr_model(spark, nb_setup):
    from labelkit.plans import training as tr

    prep, _ = nb_setup
    return tr.fit(prep, "logistic_regression")
