"""Operators for preparing training data: fixity, near-duplicates, tokens, licences, language, search, chat, toxicity, mixing."""

import sys

from pyspark import cloudpickle

# tasks carry the code of this subpackage with them, so executors need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
