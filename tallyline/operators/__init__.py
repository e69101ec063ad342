"""DataFrame -> DataFrame operators: long form (H1), windows (F1-F10),
skew-safe windows, head-to-head (D4/E17), joins (D*), aggregates and modes
(E*), consensus (J19/J21), name resolution (D14/J17/J18), mutation
(B6-B21), grading (J10/J11/J22), quality checks (J8, N*), statistics (M*)."""
