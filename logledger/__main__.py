"""``python -m logledger <job> <args...>``: the spark-submit jobs."""

from logledger.jobs import main

main()
