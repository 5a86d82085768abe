"""Where data comes from and where rules, results and samples are kept."""
