"""Column expressions built from Spark built-ins (whole-stage codegen).

text        name normalisation, accent folding, keyword patterns, quarter
            labels, header normalisers (X1-X4, F7, P1-P3)
numbers     safe casts, decimal commas, sentinels, clipping, grids (C1-C5,
            X5-X7, X9, X10)
"""
