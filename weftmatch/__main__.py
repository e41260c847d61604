from .plans.drivers import main

main()
