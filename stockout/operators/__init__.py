"""Operators, DataFrame -> DataFrame.

``report``   per-broadcast, per-option report blocks (broadcasts, products, sizes, supply,
             exposure, order figures) and their assembly
``orders``   on-air minute orders; optional low-order filter
``grid``     option x minute grid per broadcast x product, option frame and group gate
``soldout``  sold-out rule, censoring, sold-out minute and flag, observed demand
``snapshot`` running units of every option at each sold-out event
``impute``   uncensored demand by matrix factorization, training profile, held-out error
``sgd``      its unbiased form, by stochastic gradient steps
``rank_one`` its exact form, by grouped sums of whole numbers
``present``  presentation columns, types and display names
``scope``    which days and channels a run covers
"""
